"""Print the physical plans of the main searches (for PLANS.md).

    python tools/show_plans.py [sf_dir] > PLANS.md
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from quarry import Phrase, Prefix, Range, Searcher, Term, all_of, any_of
    from quarry.operators import batch, ranking
    from quarry.plans import catalog
    from quarry.session import local_session
    spark = local_session(8, 16)
    idx = catalog.docs_index(spark, sf)
    s = Searcher(idx)
    qs = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    cases = {
        "term, top 10 (C1 + E3)": ranking.top_k(s.hits(Term("text", "the")), 10),
        "boolean with a range leaf (D6 + D9)": s.hits(all_of(Term("text", "de"), any_of(
            Term("text", "la"), Range("n_chars", 10, 100)))),
        "phrase (C7)": s.hits(Phrase("text", ["of", "the"])),
        "prefix (C3)": s.hits(Prefix("text", "men")),
        "batch search, top 10 per query (G1)": batch.batch_search(idx, qs, "text", 10),
        "batch typo correction (G2)": batch.batch_fuzzy(idx, qs.select(F.explode(F.split("text", " ")).alias("word")), "text"),
    }
    print("# Physical plans\n")
    print(f"Generated by `tools/show_plans.py` at `{sf}` (local[8], AQE on; the plans are the "
          "initial adaptive plans, paths shortened).\n")
    for name, df in cases.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:/[^,\]]*", "<index>", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        print(f"## {name}\n\n```\n{plan.strip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
