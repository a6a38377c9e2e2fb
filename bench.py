"""Time the headline queries: one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every
query is built and run to the end once. The parse jobs read price-file text prepared beforehand; they
repair it, parse it and write the charges. A small query goes first, untimed, to start the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = """tall_to_long wide_to_long json_to_long repair_quotes payer_dimension code_list_price fact_rates
service_prices pct_of_medicare price_dispersion contract_type_compare dq_coverage admit_new_files""".split()


def stored_files(spark, sf_dir: str) -> dict:
    """Parse jobs over price-file text that lies ready, written out as Parquet like a real ingest."""
    from pyspark.sql import functions as F

    from tariffscope.plans import sample_files
    from tariffscope.session import materialize
    from tariffscope.sources import csv_files, headers, json_files

    jobs = {}
    for layout, files, parse in (
        ("tall", sample_files.tall_file, csv_files.tall_to_charges),
        ("wide", sample_files.wide_file, csv_files.wide_to_charges),
    ):
        heads, records = files(spark, sf_dir)
        lines, layouts = materialize(records, "lines"), materialize(headers.layouts(heads), "layouts")
        repaired = csv_files.repair(lines).select("path", "value")
        jobs[f"parse_{layout}"] = lambda parse=parse, r=repaired, k=layouts: parse(r, k)
    jobs["ingest_files"] = ingest_job(spark, sf_dir)
    texts = materialize(sample_files.json_texts(spark, sf_dir), "documents")
    docs = texts.select("hospital_id", F.from_json("value", f"struct<{json_files.ITEMS}>").alias("d"))
    jobs["parse_json"] = lambda: json_files.documents_to_charges(docs.select("hospital_id", "d.*"), "hospital_id")
    return jobs


def ingest_job(spark, sf_dir: str):
    """Tall files on disk through the whole ingest: heads, repair, parse, write, commit; read back as stored."""
    import uuid

    from tariffscope.plans import file_queries, pipeline
    from tariffscope.session import shared_dir
    from tariffscope.sources import store

    files, out = file_queries._landing(spark, sf_dir), f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}"

    def run():
        pipeline.ingest_files(spark, files, out)
        return store.read_state(spark, out)

    return run


def main() -> None:
    from tariffscope.plans.queries import queries
    from tariffscope.session import local_session, materialize

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    known["flexible_date"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name, parse in stored_files(spark, sf_dir).items():
        if not sys.argv[1:]:
            start = time.perf_counter()
            materialize(parse(), name)
            seconds[name] = round(time.perf_counter() - start, 3)
            print(f"{name:28s} {seconds[name]:8.2f}s", file=sys.stderr, flush=True)
    for name in names:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s} {seconds[name]:8.2f}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
