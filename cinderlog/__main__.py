"""Command line: python -m cinderlog --parser nginx --file access.log --dataset web ... Options are those of cinderlog.plans.options."""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields, replace

from .plans import options
from .plans.options import Options
from .sources.parsers import REGISTRY


def arguments() -> argparse.ArgumentParser:
    """An argument for each option: lists may repeat, switches take no value; PARSER.OPTION=VALUE goes to the parser."""
    p = argparse.ArgumentParser("cinderlog", description="Reads log files, turns their lines into events and delivers these.")
    p.add_argument("-c", "--config", help="an INI file of options; arguments win")
    p.add_argument("--config_yaml", help="the same as YAML")
    p.add_argument("--list", action="store_true", help="print the parsers' names")
    p.add_argument("--write_default_config", action="store_true")
    p.add_argument("--write_current_config", action="store_true")
    p.add_argument("--write_current_yaml", action="store_true")
    p.add_argument("--output", help="a folder for Parquet instead of a dataset")
    p.add_argument("--checkpoint", default="", help="a folder for the position of the stream, to follow files")
    p.add_argument("-o", "--parser_option", action="append", default=[], metavar="NAME=VALUE")
    short = {"files": ["-f", "--file", "--files"], "parser": ["-p", "--parser"], "dataset": ["-d", "--dataset"], "writekey": ["-k", "--writekey"], "samplerate": ["-r", "--samplerate"]}
    base = Options()
    for f in fields(Options):
        if f.name == "parser_options":
            continue
        names, default = short.get(f.name, [f"--{f.name}"]), getattr(base, f.name)
        if isinstance(default, bool):
            p.add_argument(*names, dest=f.name, action=argparse.BooleanOptionalAction, default=None)
        elif isinstance(default, list):
            p.add_argument(*names, dest=f.name, action="append", default=None)
        else:
            p.add_argument(*names, dest=f.name, type=int if isinstance(default, int) or f.name == "seed" else str, default=None)
    return p


def read(argv: list[str]) -> tuple[Options, argparse.Namespace]:
    got = arguments().parse_args(argv)
    o = Options()
    for path, reader in ((got.config, options.from_ini), (got.config_yaml, options.from_yaml)):
        if path:
            with open(path, encoding="utf-8") as f:
                o = reader(f.read())
    given = {f.name: getattr(got, f.name) for f in fields(Options) if f.name != "parser_options" and getattr(got, f.name) is not None}
    own = dict(x.split("=", 1) for x in got.parser_option if "=" in x)
    return replace(o, **given, parser_options=o.parser_options | own), got


def main(argv: list[str] | None = None) -> int:
    o, got = read(sys.argv[1:] if argv is None else argv)
    if got.list:
        print("\n".join(sorted(REGISTRY)))
    elif got.write_default_config:
        print(options.to_ini(Options()), end="")
    elif got.write_current_config:
        print(options.to_ini(o), end="")
    elif got.write_current_yaml:
        print(options.to_yaml(o), end="")
    else:
        try:
            run(o, got.output, got.checkpoint)
        except ValueError as e:
            print(f"cinderlog: {e}", file=sys.stderr)
            return 2
    return 0


def run(o: Options, output: str | None = None, checkpoint: str = "") -> None:
    """Reads what is there now, or follows the files where ``stop`` is not set and a checkpoint is given."""
    from pyspark.sql import DataFrame, SparkSession

    from .plans import pipeline

    o = options.prepared(o)
    if not (o.debug_stdout or output or o.api_host and o.dataset):
        raise ValueError("give an api_host and a dataset, an output folder, or debug_stdout")
    spark = SparkSession.builder.appName("cinderlog").getOrCreate()

    def sink(events: DataFrame) -> None:
        if o.debug_stdout:
            from pyspark.sql import functions as F

            for r in events.select(F.to_json(F.struct("data", "samplerate", "time")).alias("value")).toLocalIterator():
                print(r["value"])
        elif output:
            from pyspark.sql import functions as F

            events.withColumn("data", F.to_json("data")).write.mode("append").parquet(output)
        else:
            for r in pipeline.status(pipeline.deliver(events, o), o).drop("last_event").toLocalIterator():
                print(r.asDict(), file=sys.stderr)

    if checkpoint and o.files != ["-"]:
        pipeline.follow(spark, o, sink, checkpoint).awaitTermination()
    else:
        sink(pipeline.build(spark, o))


if __name__ == "__main__":
    sys.exit(main())
