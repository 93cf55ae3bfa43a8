"""Small helpers shared by tests."""


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*cols).collect()) if cols else
                  (tuple(r) for r in df.collect()), key=repr)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def values(spark, data, schema, column):
    return [r["v"] for r in spark.createDataFrame(data, schema).coalesce(1).select(column.alias("v")).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
