"""``python -m linkloom``: training, prediction, validation, threshold sweep and output check on folders of tab-separated files."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from linkloom.config import Options
from linkloom.operators import blocking as B
from linkloom.operators.check import validate_folder
from linkloom.operators.evaluate import sweep_best
from linkloom.operators.model import Classifier
from linkloom.plans import pipeline
from linkloom.runtime import local_session
from linkloom.sources.records import load_test, load_train, write_tsv


def arguments(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="linkloom", description=__doc__)
    p.add_argument("--mode", choices=["train", "predict", "all", "validate", "sweep", "check"], default="all")
    p.add_argument("--data", default="dataset", help="folder of train_source{1,2,3}.tsv, train_ground_truth.tsv and test_source{1,2,3}.tsv")
    p.add_argument("--model", default="output/model")
    p.add_argument("--output", default="output", help="folder of matching_results.tsv and candidate_pairs.tsv")
    p.add_argument("--threshold", type=float, default=Options.threshold)
    p.add_argument("--sample-size", type=int, default=50_000, help="source-1 records for training, 0 for all")
    p.add_argument("--val-split", type=float, default=0.2)
    p.add_argument("--rounds", type=int, default=Options.rounds, help="boosting rounds")
    p.add_argument("--check-ids", action="store_true", help="also check that listed ids exist")
    p.add_argument("--files", type=int, default=1, help="files of each result; 0: one for every task")
    p.add_argument("--one-line-fields", action="store_true", help="no field holds a line break: files are read in parts")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0, or 1 where the output check finds errors."""
    a = arguments(argv)
    spark = spark or SparkSession.getActiveSession() or local_session()
    options = replace(Options(), threshold=a.threshold, rounds=a.rounds)
    sample = a.sample_size if a.sample_size > 0 else None
    several = not a.one_line_fields

    def arrived(i: int, df):
        # Files have no times: rows count in the order of their sources.
        return df.withColumns({"seen_at": F.lit(None).cast("timestamp"), "loaded_at": F.timestamp_seconds(F.lit(i))})

    def sources(tables):
        return arrived(1, tables[0]), arrived(2, tables[1]).unionByName(arrived(3, tables[2]))

    if a.mode in ("train", "all"):
        tables = load_train(spark, a.data, several)
        _, scores = pipeline.run_training(*sources(tables), tables[3], a.model, options, sample, a.val_split)
        s = scores.first()
        print(f"held-out: precision {s.macro_precision:.4f}, recall {s.macro_recall:.4f}, F0.5 {s.macro_f05:.4f}")
    if a.mode in ("validate", "sweep"):
        tables = load_train(spark, a.data, several)
        data = pipeline.prepare_data(*sources(tables), tables[3], options, sample, a.val_split, sides=(True,))
        model = Classifier.load(a.model)
        if a.mode == "validate":
            print(*(f"{k} {v}" for k, v in pipeline.run_validate(model, data, a.threshold).first().asDict().items()), sep="\n")
        else:
            sweep = pipeline.run_sweep(model, data)
            for r in sweep.orderBy("cell").collect():
                print(f"threshold {r.threshold:.2f} margin {r.margin_min:.2f}: precision {r.macro_precision:.4f}, recall {r.macro_recall:.4f}, F0.5 {r.macro_f05:.4f}")
            b = sweep_best(sweep).first()
            print(f"best: threshold {b.threshold:.2f}, margin {b.margin_min:.2f}, F0.5 {b.macro_f05:.4f}")
    if a.mode in ("predict", "all"):
        one, others = sources(load_test(spark, a.data, several))
        found = pipeline.run_inference(one, others, Classifier.load(a.model), options)
        order = one.select(F.col("entity_id").alias("source1_entity_id"), F.monotonically_increasing_id().alias("at"))
        for name, lists in (("matching_results.tsv", found.matches), ("candidate_pairs.tsv", found.candidates)):
            ordered = B.in_order(lists, order, "at")
            write_tsv(ordered.coalesce(a.files) if a.files else ordered, f"{a.output}/{name}", files=None)
    if a.mode == "check":
        errors, warnings = validate_folder(spark, f"{a.output}/matching_results.tsv", f"{a.output}/candidate_pairs.tsv", a.data, a.check_ids)
        print(*[f"warning: {w}" for w in warnings], *[f"error: {e}" for e in errors], "failed" if errors else "passed", sep="\n")
        return 1 if errors else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
