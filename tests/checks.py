"""Helpers of the tests, in a module that no other folder's conftest shadows."""


def rows(df, *cols):
    """Sorted tuples of ``cols`` (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
