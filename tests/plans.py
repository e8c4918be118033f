"""What a computed plan read."""


def scans(df):
    """(files read, rows read) of every file scan of ``df``, which is computed here."""
    df.collect()
    found = []

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(plan.plan())
        if name == "FileSourceScanExec":
            metrics = plan.metrics()
            found.append((metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()))
        for side in (plan.children(), plan.subqueries()):
            for i in range(side.size()):
                walk(side.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def files_read(df):
    return sum(f for f, _ in scans(df))
