"""Comparisons that several tests share."""


def same(df, relation):
    """Whether a DataFrame and a DuckDB relation have the same columns and rows, in any order."""
    names = sorted(df.columns)
    assert names == sorted(relation.columns)
    ours = sorted(map(repr, (tuple(r) for r in df.select(*names).collect())))
    theirs = sorted(map(repr, relation.select(*(f'"{n}"' for n in names)).fetchall()))
    return ours == theirs
