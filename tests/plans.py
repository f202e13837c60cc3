"""What Spark makes of a query. Its own module: test folders may each have a `conftest`."""


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
