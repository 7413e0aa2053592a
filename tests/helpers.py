"""What several test files share. Kept out of ``conftest``, a name that each test folder has."""

SF_DIR = "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.select(*order or df.columns).collect()), key=repr)


def plan(df, mode="formatted"):
    """The physical plan as text."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
