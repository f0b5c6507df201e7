"""Small helpers for row-wise expectations."""


def rows(df, *cols):
    """The rows as a sorted list of tuples."""
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=repr)
