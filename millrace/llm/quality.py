"""Quality rules by repetition coverage: how much of a text lies in what it repeats."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import spans

# Largest share of a text's word characters that may lie in repeated runs of n words (the usual published
# ones). A longer run is also runs of 8, which the base rule bounds at 0.30: only limits below that add to it.
RUN_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
# Largest share of the word characters in lines that repeat an earlier line. The base rule also counts the first occurrence
# of a line of 8 words, and so implies about 0.15.
LINE_LIMIT = 0.12

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "dup_line_chars long, " + ", ".join(f"repeat_chars_{n} long" for n in RUN_LIMITS) +
          ", base_failed boolean, kept boolean")


def measure(strings, run_limits=RUN_LIMITS, line_limit=LINE_LIMIT):
    """Counts and verdict of each text as a dict of arrays; see :func:`quality_rules`."""
    texts = spans.Texts(strings)
    n = texts.n
    starts, ends, text = texts.words()
    chars = texts.code_points(starts, ends)
    hashes = spans.SpanHasher.of_bytes(texts.data)(starts, ends)
    per_text = lambda mask, weight=None: np.bincount(
        text[mask], None if weight is None else weight[mask], n).astype(np.int64)
    everything = np.ones(len(text), dtype=bool)
    out = {"n_words": per_text(everything), "word_chars": per_text(everything, chars)}
    marks = np.flatnonzero(SYMBOLS[texts.data])
    out["n_symbols"] = np.searchsorted(marks, texts.ends) - np.searchsorted(marks, texts.starts)

    line_starts, line_ends, line_text = texts.lines()
    full = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_text = line_starts[full], line_ends[full], line_text[full]
    keys = spans.within(spans.SpanHasher.of_bytes(texts.data, 1)(line_starts, line_ends), line_text)
    again = np.ones(len(keys), dtype=bool)
    again[np.unique(keys, return_index=True)[1]] = False
    total = np.concatenate(([0], np.cumsum(chars)))
    line_chars = total[np.searchsorted(starts, line_ends)] - total[np.searchsorted(starts, line_starts)]
    out["n_dup_lines"] = np.bincount(line_text[again], None, n).astype(np.int64)
    out["dup_line_chars"] = np.bincount(line_text[again], line_chars[again], n).astype(np.int64)

    bad = out["dup_line_chars"] > line_limit * out["word_chars"]
    for size in sorted({8, *run_limits}):
        runs, at = spans.windows(hashes, text, size)
        mask = spans.covered(at[spans.repeated(spans.within(runs, text[at]))], size, len(text))
        if size == 8:
            out["n_repeat_words"] = per_text(mask)
        if size in run_limits:
            out[f"repeat_chars_{size}"] = per_text(mask, chars)
            bad |= out[f"repeat_chars_{size}"] > run_limits[size] * out["word_chars"]
    out["base_failed"] = (out["n_words"] < 20) | (100 * out["n_repeat_words"] > 30 * out["n_words"])
    out["kept"] = ~out["base_failed"] & ~bad
    return out


def _rows(batches):
    names = [c.split()[0] for c in SCHEMA.split(", ")][1:]
    for rows, strings in spans.chunks(batches):
        found = measure(strings)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(found[c]) for c in names)], ["doc_id", *names])


def quality_rules(docs: DataFrame) -> DataFrame:
    """Judge every whole text of ``docs`` (``doc_id``, ``text``) in one pass without a shuffle.

    Rolling hashes of 5 to 10 words, and hashes of lines, find what a text repeats; coverage is the
    share of its word characters inside repeated runs (first occurrence included) and inside lines equal
    to an earlier one. A text fails the base rules with under 20 words or when over 30 % of its words lie
    in repeated runs of 8; it is kept when it passes them and no coverage is over its limit.

    A null or empty text has no words: all counts 0, base failed. Repeated rows, null ids and ties
    are judged row by row; other columns are ignored; an empty table gives an empty result. Memory is
    bounded by a chunk of texts or by the longest text.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_rows, SCHEMA)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with all their columns, in the same pass."""
    schema = docs.schema

    def kept(batches):
        for rows, strings in spans.chunks(batches):
            yield rows.filter(pa.array(measure(strings)["kept"]))

    return docs.mapInArrow(kept, schema)
