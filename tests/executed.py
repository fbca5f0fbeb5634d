"""What a finished adaptive plan really ran."""


def _children(seq):
    return [seq.apply(i) for i in range(seq.size())]


def scans(df) -> list[str]:
    """Files scanned by the final plan and its subqueries; reused stages count once."""
    df.collect()
    seen, out = set(), []

    def walk(p):
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if name in ("ReusedExchangeExec", "ReusedSubqueryExec"):
            return None
        if name.endswith("QueryStageExec"):
            return walk(p.plan())
        if p.id() in seen:
            return None
        seen.add(p.id())
        if name == "FileSourceScanExec":
            path = p.relation().location().rootPaths().head().toString()
            out.append(path.rsplit("/", 1)[-1].removesuffix(".parquet"))
        for s in _children(p.subqueries()):
            walk(s)
        for c in _children(p.children()):
            walk(c)

    walk(df._jdf.queryExecution().executedPlan())
    return sorted(out)


def final_plan(df) -> str:
    """The adaptive plan after it has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows_scanned(df) -> int:
    """Rows that the scans of the finished plan decoded: those of the row groups and pages that statistics did not rule out."""
    df.collect()
    total = 0

    def walk(p):
        nonlocal total
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(p.plan())
        if name == "FileSourceScanExec":
            total += p.metrics().apply("numOutputRows").value()
        for c in _children(p.children()):
            walk(c)

    walk(df._jdf.queryExecution().executedPlan())
    return total
