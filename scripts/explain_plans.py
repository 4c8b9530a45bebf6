"""Write PLANS.md: the executed physical plans (after AQE) of the main
queries over a year/month-partitioned CUR dataset, with scan details.
Usage: python scripts/explain_plans.py [sf_dir]"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from costmart.operators import dims, fact, summary  # noqa: E402
from costmart.session import local_session, scratch_path  # noqa: E402
from costmart.sinks import writers  # noqa: E402
from costmart.sources import fixtures as FX  # noqa: E402
from costmart.sources import readers  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = local_session(8, 32)
spark.sparkContext.setLogLevel("ERROR")
path = scratch_path(spark, "plans-cur")
writers.write_partitioned(FX.cur_from_tables(spark, sf_dir), path)
cur = readers.read_parquet(spark, path)
inst = FX.instances_from_tables(spark, sf_dir)

QUERIES = {
    "cost_fact_direct (one aggregation)": fact.fact_direct(cur, as_of=FX.AS_OF),
    "cost_fact (two aggregations, original shape)": fact.fact(summary.summary(cur, as_of=FX.AS_OF)),
    "summary_view": summary.summary(cur, as_of=FX.AS_OF),
    "tag_dim (one aggregation of the line items)": dims.tag_dim(summary.line_items(cur, FX.AS_OF)),
    "resource_dim (instance lookup join)": dims.resource_dim(summary.line_items(cur, FX.AS_OF), inst, with_name=True),
    "account_dim (whole history)": dims.account_dim(cur),
    "date_dim (whole history)": dims.date_dim(cur),
}

out = ["# Physical plans", "",
       f"Executed plans (AQE final) over the CUR derived from `{sf_dir}`, written as a year/month-partitioned",
       "parquet dataset, `local[8]`. Generated by `scripts/explain_plans.py`; scan details follow each tree.", ""]
jvm = spark.sparkContext._jvm
formatted = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
for title, df in QUERIES.items():
    df.collect()  # run it, so the adaptive plan below is the final one
    text = df._jdf.queryExecution().explainString(formatted)
    tree, _, details = text.partition("\n\n\n")
    out += [f"## {title}", "", "```", tree.strip(), "```", ""]
    for block in details.split("\n\n"):
        if block.lstrip().startswith("(") and "Scan parquet" in block.splitlines()[0]:
            keep = [l for l in block.splitlines() if l.startswith(("(", "Location", "PartitionFilters", "PushedFilters", "ReadSchema"))]
            out += ["```", *[k[:600] for k in keep], "```", ""]
open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write("\n".join(out))
print("wrote PLANS.md")
