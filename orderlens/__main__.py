"""The jobs as commands, for ``spark-submit`` or ``python -m orderlens``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from orderlens.operators import model
from orderlens.plans import medallion, retraining
from orderlens.session import build_session

PRESETS = {"monthly": model.MONTHLY, "local": model.LOCAL, "scheduled": model.SCHEDULED}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="orderlens", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    for job in ("land", "sync"):
        one = jobs.add_parser(job, help="raw CSV files into Bronze")
        one.add_argument("raw")
        one.add_argument("lakehouse")
        one.add_argument("--file", action="append", default=[], metavar="TABLE=NAME", help="file of a table, if not TABLE.csv")
    for job in ("refine", "publish"):
        jobs.add_parser(job, help={"refine": "Bronze to Silver", "publish": "Silver to Gold"}[job]).add_argument("lakehouse")
    export = jobs.add_parser("export", help="Gold into warehouse tables")
    export.add_argument("lakehouse")
    export.add_argument("--database", default="analytics")
    export.add_argument("--width", action="append", default=[], metavar="COLUMN=N", help="width of a text column")
    monthly = jobs.add_parser("monthly", help="Silver, Gold, training, gate, monitoring")
    monthly.add_argument("lakehouse")
    monthly.add_argument("--preset", choices=PRESETS, default="monthly")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    spark = build_session(f"orderlens-{given.job}")
    if given.job in ("land", "sync"):
        files = dict(one.split("=", 1) for one in given.file)
        print(getattr(medallion, given.job)(spark, given.raw, given.lakehouse, files))
    elif given.job == "refine":
        medallion.preview(medallion.refine(spark, given.lakehouse))
    elif given.job == "publish":
        print(sorted(medallion.publish(spark, given.lakehouse)))
    elif given.job == "export":
        widths = {name: int(n) for name, n in (one.split("=", 1) for one in given.width)}
        medallion.export(spark, given.lakehouse, given.database, widths=widths)
    else:
        run = retraining.monthly_job(spark, given.lakehouse, PRESETS[given.preset])
        medallion.preview(run.training.report)


if __name__ == "__main__":
    main()
