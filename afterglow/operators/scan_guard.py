"""A cap on what a query may scan, checked on its plan before it runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation

#: Caps of interactive queries and of models, in bytes.
INTERACTIVE_CAP = 5 << 30
MODEL_CAP = 25 << 30


class ScanLimitExceeded(RuntimeError):
    pass


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the leaves of the optimised plan, as Spark estimates them after partition pruning."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def guarded(df: DataFrame, cap: int = INTERACTIVE_CAP) -> DataFrame:
    """The same DataFrame, unless it would scan more than the cap."""
    size = scanned_bytes(df)
    if size > cap:
        raise ScanLimitExceeded(f"the query would scan {size} bytes; the cap is {cap}")
    return df


def read_bytes(df: DataFrame) -> int:
    """Bytes of the files that the scans of a DataFrame's plan read, once it has run."""
    total, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if node.metrics().contains("filesSize"):
            total += int(str(node.metrics().apply("filesSize").value()))
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            waiting.append(node.plan())
        else:
            children = node.children()
            waiting += [children.apply(i) for i in range(children.size())]
    return total


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The DataFrame with named metrics that are counted while it is written, and where they arrive."""
    seen = Observation(name)
    return df.observe(seen, *(m.alias(n) for n, m in metrics.items())), seen
