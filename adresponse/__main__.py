"""Command line for the scheduled workflow: ``python -m adresponse <step> ...``.

Steps run on the session ``spark-submit`` provides (or a local one):

    ingest   --impressions T --identity T --training T --runlog T [--as-of ISO] [--input-bytes N] [--concurrent]
    tune     --training T --runlog T [--model MODEL1|MODEL2] [--campaigns T] [--evals 2] [--parallelism 4]
    retrain  --training T --runlog T --model-path P [--model MODEL1|MODEL2] [--campaigns T]
    score    --requests T --model1-path P --model2-path P --campaigns T --inference T [--pct-model1 50] [--strict]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .config import MODEL1, MODEL2, IngestSpec
from .plans import jobs
from .session import SCALE_CONF, checkpoint_dir

SPECS = {"MODEL1": MODEL1, "MODEL2": MODEL2}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="adresponse")
    sub = ap.add_subparsers(dest="step", required=True)
    ing = sub.add_parser("ingest")
    for a in ("--impressions", "--identity", "--training", "--runlog"):
        ing.add_argument(a, required=True)
    ing.add_argument("--as-of")
    ing.add_argument("--input-bytes", type=int)
    ing.add_argument("--concurrent", action="store_true", help="make a table that overlapping runs may write")
    ing.add_argument("--excluded-partner", default=IngestSpec().excluded_partner)
    tune = sub.add_parser("tune")
    for a in ("--training", "--runlog"):
        tune.add_argument(a, required=True)
    tune.add_argument("--model", default="MODEL1", choices=SPECS)
    tune.add_argument("--campaigns")
    tune.add_argument("--as-of")
    tune.add_argument("--evals", type=int, default=2)
    tune.add_argument("--parallelism", type=int, default=4)
    rt = sub.add_parser("retrain")
    for a in ("--training", "--runlog", "--model-path"):
        rt.add_argument(a, required=True)
    rt.add_argument("--model", default="MODEL1", choices=SPECS)
    rt.add_argument("--campaigns")
    rt.add_argument("--as-of")
    rt.add_argument("--input-bytes", type=int)
    sc = sub.add_parser("score")
    for a in ("--requests", "--model1-path", "--model2-path", "--campaigns", "--inference"):
        sc.add_argument(a, required=True)
    sc.add_argument("--pct-model1", type=float, default=50.0)
    sc.add_argument("--strict", action="store_true", help="refuse requests that break a model's contract")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"adresponse-{args.step}").getOrCreate()
    # UTC session clock (event times are naive UTC), AQE and its skew join
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    if args.step == "ingest":
        out = jobs.ingest_job(spark, args.impressions, args.identity, args.training, args.runlog,
                              args.as_of, IngestSpec(excluded_partner=args.excluded_partner),
                              input_bytes=args.input_bytes, concurrent=args.concurrent)
        print(json.dumps(out.first().asDict(), default=str))
    elif args.step == "tune":
        trials = jobs.tune_job(spark, args.training, args.runlog, SPECS[args.model], args.campaigns,
                               args.as_of, args.evals, args.parallelism)
        for r in trials.collect():
            print(json.dumps(r.asDict()))
    elif args.step == "retrain":
        m = jobs.retrain_job(spark, args.training, args.runlog, args.model_path, SPECS[args.model],
                             args.campaigns, args.as_of, input_bytes=args.input_bytes)
        print(json.dumps({"model": m.spec.name, "run_id": m.run_id, "trees": m.n_trees}))
    else:
        log = jobs.score_job(spark, args.requests, args.model1_path, args.model2_path, args.campaigns,
                             args.inference, args.pct_model1, strict=args.strict)
        print(json.dumps({"inference_rows": log.count()}))


if __name__ == "__main__":
    main()
