"""Reading physical plans."""


def plan_of(df):
    """The executed plan; final once the DataFrame has run."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def run_plan(df):
    df.collect()
    return plan_of(df)
