"""Per-query physical-plan summary (run: python tests/plan_stats.py <sf_dir>)."""
import sys, re; sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
from scorewatch.session import build_session
from scorewatch.registry import QUERIES
spark = build_session("local[8]", 16); spark.sparkContext.setLogLevel("ERROR")
print("| query | scans | exchanges | broadcast joins | sort-merge joins | sort aggregates | hash aggregates | windows | window group limits | Python / cartesian / nested loop |")
print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
for q, fn in QUERIES.items():
    df = fn(spark, sys.argv[1])
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    c = lambda s: plan.count(s)
    bad = c("BatchEvalPython") + c("ArrowEvalPython") + c("CartesianProduct") + c("BroadcastNestedLoopJoin")
    print(f"| {q} | {c('FileScan parquet')} | {len(re.findall(r'Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)', plan))} | {c('BroadcastHashJoin')} | {c('SortMergeJoin')} | {c('SortAggregate')} | {c('HashAggregate')} | {len(re.findall(r'Window \[', plan))} | {c('WindowGroupLimit')} | {bad} |")
