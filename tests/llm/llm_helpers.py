"""Shared by the tests of this folder."""


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))
