"""Shared by the test modules; not in conftest, whose name other test folders use too."""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
