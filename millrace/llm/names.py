"""Columns of the caller beside an operator's own."""

import functools


def apart(operator):
    """An operator that returns the columns of its first argument, made to leave those alone whose names begin with the two
    underscores of its own: they have other names while it runs."""
    @functools.wraps(operator)
    def run(docs, *args, **kwargs):
        names = docs.columns
        if not any(n.startswith("__") for n in names):
            return operator(docs, *args, **kwargs)
        prefix = "caller"
        while any(n.lower().startswith(prefix) for n in names):
            prefix += "_"
        hidden = docs.toDF(*(f"{prefix}{i}" if n.startswith("__") else n for i, n in enumerate(names)))
        return operator(hidden, *args, **kwargs).toDF(*names)
    return run
