"""Command line: ``python -m lightfold todolist | tasks | classify | train | final ...``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from . import classify, training
from .schemas import CLASSIFIERS, TRAINING_SETS, Level1, Level2
from .sources import lightcurves
from .sources.documents import load_json
from .store import DiagnosticsNotAvailableError, Store


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lightfold")
    jobs = parser.add_subparsers(dest="job", required=True)
    todo = jobs.add_parser("todolist", help="build a store from light curve files")
    todo.add_argument("folder")
    todo.add_argument("store")
    todo.add_argument("--pattern", default=None, help="file names, as a glob")
    tasks = jobs.add_parser("tasks", help="count tasks that are left")
    tasks.add_argument("store")
    tasks.add_argument("-c", "--classifier", default=None, choices=CLASSIFIERS)
    run = jobs.add_parser("classify", help="classify all pending targets and assign final classes")
    run.add_argument("store")
    run.add_argument("folder", help="where the light curves lie")
    run.add_argument("--datadir", required=True, help="where the trained classifiers lie")
    run.add_argument("-c", "--classifier", default=None, choices=CLASSIFIERS)
    run.add_argument("--chunks", type=int, default=None, help="targets to take at a time (all)")
    run.add_argument("-o", "--overwrite", action="store_true", help="forget earlier results")
    run.add_argument("--clear-cache", action="store_true", help="forget cached features too")
    run.add_argument("--truncate", action=argparse.BooleanOptionalAction, default=False, help="cut long series to 27.4 days")
    fit = jobs.add_parser("train", help="train all classifiers on a labelled store, or on a target list that a store is made of")
    fit.add_argument("store")
    fit.add_argument("folder", help="where the light curves lie")
    fit.add_argument("--datadir", required=True, help="where the trained classifiers go")
    fit.add_argument("--targets", default=None, help="a target list")
    fit.add_argument("--class-column", default="label", help="the list's column of labels")
    fit.add_argument("--sizes", default=None, help="JSON of settings by classifier")
    fit.add_argument("-tf", "--testfraction", type=float, default=0.2)
    for job in (run, fit):
        job.add_argument("-t", "--trainingset", default="keplerq9v3", choices=TRAINING_SETS)
        job.add_argument("-l", "--level", default="L1", choices=("L1", "L2"))
    fit.add_argument("--linfit", action="store_true", help="take a straight line off each series")
    final = jobs.add_parser("final", help="assign final classes")
    final.add_argument("store")
    final.add_argument("thresholds", help="JSON of class to threshold, gzipped or not")
    return parser


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job == "classify" and args.clear_cache and not args.overwrite:
        parser.error("--clear-cache needs --overwrite")
    if args.job == "classify" and args.chunks is not None and args.chunks < 1:
        parser.error("--chunks must be at least 1")
    if args.job == "train" and not 0 <= args.testfraction < 1:
        parser.error("--testfraction must be at least 0 and under 1")
    spark = SparkSession.builder.appName("lightfold").getOrCreate()
    if args.job == "todolist":
        files = lightcurves.files(spark, args.folder, glob=args.pattern)
        Store.create(spark, args.store, files.selectExpr("priority", "path AS lightcurve"))
    elif args.job == "tasks":
        print(Store(spark, args.store).number_of_tasks(args.classifier))
    elif args.job == "final":
        Store(spark, args.store).assign_final_class(load_json(args.thresholds))
    else:
        classes = tuple(c.name for c in (Level1 if args.level == "L1" else Level2))
        if args.job == "classify":
            store = Store(spark, args.store, classes, overwrite=args.overwrite)
            if args.clear_cache:
                store.clear_features()
            try:
                classify.classify(store, classify.Models.load(spark, args.datadir), args.folder, args.trainingset, args.classifier, args.chunks, args.truncate)
            except DiagnosticsNotAvailableError:
                print("no final classes: the classifiers were trained without a test fraction", file=sys.stderr)
        else:
            if args.targets:
                listed = training.target_files.read_ecsv(spark, args.targets, args.class_column)
                training.build_store(spark, args.store, listed, list(classes), args.folder)
            store = Store(spark, args.store, classes)
            models = classify.train(store, args.folder, args.trainingset, args.testfraction, args.linfit, sizes=json.loads(args.sizes) if args.sizes else None)
            models.save(spark, args.datadir)
    return 0


if __name__ == "__main__":
    sys.exit(main())
