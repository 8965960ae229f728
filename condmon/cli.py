"""Command line for the four jobs.

    python -m condmon.cli publish --datasets both --bearing-root R --toolwear-root T --out DIR
    python -m condmon.cli train-bearing --root R --model DIR [--trees N]
    python -m condmon.cli train-toolwear --root T --model DIR [--trees N]
    python -m condmon.cli serve --bearing-model DIR --toolwear-model DIR --records DIR \
        --sinks DIR --checkpoints DIR [--available-now]

The session comes from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The active session, or the one ``spark-submit`` configures; a session
    that cannot start is an error."""
    return SparkSession.getActiveSession() or SparkSession.builder.appName("condmon").getOrCreate()


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="condmon")
    sub = p.add_subparsers(dest="cmd", required=True)
    pub = sub.add_parser("publish")
    pub.add_argument("--datasets", default="both")
    pub.add_argument("--bearing-root")
    pub.add_argument("--toolwear-root")
    pub.add_argument("--out")
    pub.add_argument("--bootstrap")
    pub.add_argument("--key-rule", default="exact", choices=["exact", "suffix"])
    for name in ("train-bearing", "train-toolwear"):
        t = sub.add_parser(name)
        t.add_argument("--root", required=True)
        t.add_argument("--model", required=True)
        t.add_argument("--trees", type=int)
        if name == "train-toolwear":
            t.add_argument("--grouped", action="store_true", help="keep an experiment on one side of the split")
    srv = sub.add_parser("serve")
    srv.add_argument("--bearing-model", required=True)
    srv.add_argument("--toolwear-model", required=True)
    srv.add_argument("--records")
    srv.add_argument("--bootstrap")
    srv.add_argument("--sinks", required=True)
    srv.add_argument("--checkpoints", required=True)
    srv.add_argument("--max-files-per-trigger", type=int)
    srv.add_argument("--available-now", action="store_true")
    a = p.parse_args(argv)
    spark = _session()

    if a.cmd == "publish":
        from condmon.plans.publish import publish

        ok = publish(spark, a.datasets, a.bearing_root, a.toolwear_root, a.out, a.bootstrap, a.key_rule)
        if not ok:
            print(f"no valid dataset selection: {a.datasets}", file=sys.stderr)
        return 0
    if a.cmd in ("train-bearing", "train-toolwear"):
        from condmon.plans import training

        params = {"maxIter": a.trees} if a.trees else None
        if a.cmd == "train-bearing":
            trained = training.train_rul_model(spark, a.root, a.model, params)
        else:
            trained = training.train_wear_model(spark, a.root, a.model, params, a.grouped)
        trained.metrics.show(truncate=False)
        return 0
    if a.cmd == "serve":
        from condmon.plans.serving import serve
        from condmon.streaming.bearing import await_all, await_any

        source = "kafka" if a.bootstrap else "files"
        qs = serve(spark, a.bearing_model, a.toolwear_model, a.sinks, a.checkpoints, source=source,
                   path=a.records, bootstrap=a.bootstrap, max_files_per_trigger=a.max_files_per_trigger,
                   available_now=a.available_now)
        # a drained replay ends by itself; a service ends with its first query
        await_all(qs) if a.available_now else await_any(qs)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
