"""Command line: run the pipeline, validate its results, serve them.

python -m kindred.cli run --train-dir T --test-dir S --output-dir O
python -m kindred.cli validate --matching M --candidate C --test-dir S      (exit status 1 if not valid)
python -m kindred.cli serve --port 8000 --train-dir T --test-dir S --output-dir O
"""

from __future__ import annotations

import argparse
import sys

from .operators.validate import summary, validate_files
from .plans.resolve import run_pipeline
from .session import get_session
from .sources.tables import read_tsv


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kindred", description="Record linkage between one clean table and several noisy ones")
    p.add_argument("--master", help="the cluster; by default what spark-submit or the Spark settings say")
    sub = p.add_subparsers(dest="command", required=True)

    def folders(c: argparse.ArgumentParser) -> None:
        c.add_argument("--train-dir", default="dataset/train", help="folder of train_source1.tsv to train_source3.tsv and train_ground_truth.tsv")
        c.add_argument("--test-dir", default="dataset/test", help="folder of test_source1.tsv to test_source3.tsv")
        c.add_argument("--output-dir", default="output", help="folder for matching_results.tsv, candidate_pairs.tsv and experiment_report.json")

    run = sub.add_parser("run", help="train, resolve, write and validate")
    folders(run)
    run.add_argument("--random-seed", type=int, default=42)
    run.add_argument("--skip-validation", action="store_true")
    check = sub.add_parser("validate", help="check result files")
    for name in ("matching", "candidate", "test-dir"):
        check.add_argument(f"--{name}", required=True)
    web = sub.add_parser("serve", help="answer HTTP requests")
    folders(web)
    web.add_argument("--port", type=int, default=8000)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = get_session(args.master)
    if args.command == "run":
        out = run_pipeline(spark, args.train_dir, args.test_dir, args.output_dir, args.random_seed, args.skip_validation)
        for name, n in out["counts"].items():
            print(f"{name}: {n} rows")
        for name, value in out["metrics"].items():
            if not isinstance(value, list):
                print(f"{name}: {value}")
        print(f"validation: {'skipped' if out['validation_passed'] is None else 'passed' if out['validation_passed'] else 'failed'}")
        return 0 if out["validation_passed"] in (True, None) else 1
    if args.command == "validate":
        found = validate_files(spark, args.matching, args.candidate, args.test_dir).limit(20).collect()
        for r in found:
            print(f"[FAIL] {r.check}: {r.detail} {r.id or ''}".rstrip())
        if not found:
            print("[SUCCESS] " + ", ".join(f"{k}: {v}" for k, v in summary(read_tsv(spark, args.matching)).first().asDict().items()))
        return 1 if found else 0
    from .service import serve

    serve(spark, args.train_dir, args.test_dir, args.output_dir, args.port)
    return 0


if __name__ == "__main__":
    sys.exit(main())
