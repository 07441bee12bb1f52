"""Splitting a behaviour record into page, start, display, action and error records."""

from pyspark.sql import functions as F

from millrace.functions import records as R


def write_flag(parsed, flag="is_new"):
    """Put the repaired flag column back into ``record``, touching only records it changed."""
    common = R.as_record(F.col("record")["common"])
    rewritten = R.put(F.col("record"), common=R.as_variant(R.put(common, is_new=F.col(flag))))
    changed = ~F.col(flag).eqNullSafe(R.get_text(F.col("record")["common"], "$.is_new"))
    return parsed.withColumn("record", F.when(changed, rewritten).otherwise(F.col("record")))


def _outputs():
    """The condition and the list of JSON texts of each target.

    A record with ``err`` goes to error whole and is then handled without it. A record with
    ``start`` goes to start only. Any other yields its displays and actions, each with the common
    part as JSON text and the page id (displays also with the time), and what is left as a page.
    """
    record = F.col("record")
    has_error = R.get_text(record["err"]).isNotNull()
    is_start = R.get_text(record["start"]).isNotNull()
    common = R.get_text(record["common"])
    page_id = R.get_text(record["page"], "$.page_id")
    clean = R.remove(record, "err")

    def items(name, **extra):
        listed = R.get_items(record[name])
        made = F.transform(listed, lambda item: R.serialise(
            R.put(R.as_record(item), common=common, page_id=page_id, **extra)))
        return F.filter(made, lambda text: text.isNotNull())

    return {
        "page": (~is_start, F.array(R.serialise(R.remove(clean, "displays", "actions")))),
        "start": (is_start, F.array(R.serialise(clean))),
        "display": (~is_start, items("displays", ts=F.col("ts"))),
        "action": (~is_start, items("actions")),
        "error": (has_error, F.array(R.serialise(record))),
    }


def split_log(parsed, keep=()):
    """The five outputs as ``{target: DataFrame(value)}``, each lazily derived from ``parsed``.

    An output that is used alone serialises nothing of the others. ``keep`` names columns to carry along.
    """
    return {target: parsed.filter(condition).select(*keep, F.explode(texts).alias("value"))
            for target, (condition, texts) in _outputs().items()}


def _labelled(target):
    return F.transform(F.col(target), lambda text: F.struct(F.lit(target).alias("target"), text.alias("value")))


def route_log(parsed, keep=(), usable=None):
    """The five outputs as rows ``(target, value)`` in one pass over the records.

    This is the form to write: one parse and one job, whatever the number of targets. The
    conditions are columns of their own so that each is evaluated once. ``usable`` names a boolean column: where it is false
    the record's text, readable or not, is the one row of a sixth target, ``dirty``.
    """
    outputs = _outputs()
    if usable:
        outputs = {t: (F.col(usable) & condition, texts) for t, (condition, texts) in outputs.items()}
        outputs["dirty"] = (~F.col(usable), F.array("value"))
    none = F.array().cast("array<string>")
    texts = [F.coalesce(F.when(condition, listed), none).alias(t) for t, (condition, listed) in outputs.items()]
    listed = F.flatten(F.array(*[_labelled(t) for t in outputs]))
    return (parsed.select(*keep, *texts)
                  .select(*keep, F.explode(listed).alias("_out"))
                  .select(*keep, "_out.target", "_out.value"))
