"""covey: steps of a pack run, one by one or all."""

from __future__ import annotations

import argparse

from . import state


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="covey", description=__doc__)
    out.add_argument("--dump", required=True, help="tar, TSV or TSV.gz file of observations")
    out.add_argument("--folder", required=True, help="folder of the run, shared by all executors")
    out.add_argument("--version", default="dev", help="version of the packs")
    out.add_argument("--max-region-mb", type=float, default=80.0)
    out.add_argument("--min-checklists", type=int, default=100)
    out.add_argument("--boundary-resolution", type=int, default=4)
    out.add_argument("--no-header", action="store_true")
    out.add_argument("--force", action="store_true", help="run completed steps again")
    steps = out.add_subparsers(dest="step", required=True)
    for name in state.STEPS:
        steps.add_parser(name)
    every = steps.add_parser("run-all")
    every.add_argument("--from-step", choices=state.STEPS)
    steps.add_parser("status")
    steps.add_parser("size-manifest", help="sizes of what was built, by boundary cell")
    bundle = steps.add_parser("bundle", help="groups the built packs into releases")
    bundle.add_argument("--max-bundle-mb", type=int, default=1950)
    analyse = steps.add_parser("analyse", help="compares translation tables (species, language, name)")
    analyse.add_argument("tables", nargs="+", help="name=path of Parquet tables; with three the last is what the others are held against")
    analyse.add_argument("--output", required=True)
    return out


def main(arguments: list[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    if given.step == "status":
        for name, status, seconds in state.Run(f"{given.folder}/state.json").table():
            print(f"{name:10} {status:10} {'' if seconds is None else f'{seconds:.0f} s'}")
        return
    from pyspark.sql import SparkSession

    from ..operators import planning
    from ..sinks import files as sinks
    from .packs import PackRun

    run = PackRun(SparkSession.builder.appName("covey").getOrCreate(), given.dump, given.folder, given.version, given.max_region_mb, given.min_checklists, given.boundary_resolution, not given.no_header)
    if given.step == "analyse":
        from . import analysis

        analysis.export({n: run.spark.read.parquet(p) for n, _, p in (t.partition("=") for t in given.tables)}, given.output)
    elif given.step == "size-manifest":
        run.size_manifest()
    elif given.step == "bundle":
        sinks.document({"version": given.version, "bundles": [r.asDict() for r in planning.bundles(run.read("packs").select("region_id", "size_bytes"), given.max_bundle_mb, given.version).orderBy("bundle_id", "region_id").collect()]}, run.path("bundles.json"))
    elif given.step == "run-all":
        run.go(given.from_step, given.force)
    else:
        run.one(given.step)


if __name__ == "__main__":
    main()
