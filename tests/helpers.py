"""What several test modules share. Not in conftest: folders below have a conftest of their own."""

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def rows_of(df):
    """All rows as sorted tuples with columns in name order; sums may end in another last bit."""

    def plain(value):
        return round(value, 9) + 0.0 if isinstance(value, float) else value

    rows = df.select(*sorted(df.columns)).collect()
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)
