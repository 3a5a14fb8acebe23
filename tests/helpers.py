def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(spark, value, expression, kind="string"):
    """Value of a column expression built from one cell."""
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(expression("c").alias("r")).first()["r"]


def jobs_of(spark, build):
    """How many Spark jobs ``build`` starts."""
    context = spark.sparkContext
    context.setJobGroup("counted", "jobs of a test")
    before = len(context.statusTracker().getJobIdsForGroup("counted"))
    try:
        build()
        return len(context.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        context.setJobGroup("tests", "other tests")


def parquet_reads(df, table=""):
    """How often the plan that ran reads a Parquet table, reused exchanges counted once."""
    df.collect()

    def reads(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            return reads(plan.executedPlan())
        if name.startswith("ReusedExchange"):
            return 0
        if "QueryStage" in name:
            return reads(plan.plan())
        children = plan.children()
        below = sum(reads(children.apply(i)) for i in range(children.size()))
        return below + (name.startswith("Scan parquet") and f"{table}.parquet" in plan.toString() if table else name.startswith("Scan parquet"))

    return reads(df._jdf.queryExecution().executedPlan())
