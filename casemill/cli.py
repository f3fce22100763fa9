"""Command line: ``python -m casemill.cli <command> ...``."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from casemill.functions import names
from casemill.session import build_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="casemill", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, /, *needs: str, **options):
        c = sub.add_parser(name)
        for n in needs:
            c.add_argument(f"--{n}", required=True)
        for n, default in options.items():
            flag = f"--{n.replace('_', '-')}"
            if default is False:
                c.add_argument(flag, action="store_true")
            elif isinstance(default, list):
                c.add_argument(flag, action="append", default=None)
            else:
                c.add_argument(flag, type=type(default) if default is not None else str, default=default)
        return c

    command("list-tables", "raw-dir")
    command("inventory", "raw-dir", output=None)
    command("init", "store")
    command("ingest", "raw-dir", "store", table=[])
    command("validate", "raw-dir", "store", table=[])
    command("reset", "store", table=[])
    command("cleanup", "store")
    command("quality", "store", output_dir=None)
    command("catalog", "raw-dir", "store", output_dir=None, sample_values=5)
    command("features", "raw-dir", "store", smoke_limit=1000, full=False, execute=False, confirm_full_execute=False)
    command("select", "raw-dir", "store", "selection", smoke_limit=1000, full=False, execute=False, confirm_full_execute=False)
    for n in ("export", "validate-export"):
        command(n, "raw-dir", "store", "output", selection=None, all_features=False, family=[], full=False, force=False, smoke_limit=1000, compression="zstd")
    command("join", "raw-dir", "store", "output", "modeling", selection=None, all_features=False, full=False, smoke_limit=1000)
    command("split", "modeling", "labels", output=None)
    command("train", "modeling", "labels", selection=None, all_features=False, output_dir=None, class_weight=None, full=False, train_row_limit=100_000, eval_row_limit=50_000, iterations=50, keep=[])
    command("diagnose", "modeling", "labels", selection=None, all_features=False, output=None, class_weight=[], keep=[], train_row_limit=250_000, iterations=50)
    command("benchmark", "modeling", "labels", selection=None, all_features=False, output=None, keep=[], train_row_limit=200_000)
    command("compare", "registry", name=None, artifact_dir=None, labels=None, role="candidate", official=None, split="test")
    return p


def weight(text: str | None):
    if text in (None, "none"):
        return None
    return text if text == "balanced" else float(text)


def run(args: argparse.Namespace, spark) -> object:
    from casemill.operators import model, profile, registry, temporal
    from casemill.plans import assemble, catalog, selection, specs
    from casemill.plans.assemble import BASE
    from casemill.session import exists, read_text, write_text
    from casemill.sources import export, inventory, store, tables

    if args.command in ("features", "select") and args.full and args.execute and not args.confirm_full_execute:
        raise SystemExit("a full run with --execute needs --confirm-full-execute")
    s = store.Store(spark, args.store) if getattr(args, "store", None) else None

    def told(value, path: str | None):
        """``value``, also written as JSON where a path is given."""
        if path:
            write_text(spark, path, json.dumps(value, indent=2, default=str) + "\n")
        return value

    def frames():
        return {t.name: s.read(t.name) for t in tables.discover(spark, args.raw_dir)}

    def columns(found, samples: int = 0):
        defined = {r[0]: r[1] for r in inventory.read_definitions(spark, f"{args.raw_dir.rstrip('/')}/feature_definitions.csv").collect()}
        values = {n: tables.sample_values(df, names.grain(df.columns), samples) for n, df in found.items()} if samples else {}
        return catalog.catalog_columns({n: df.schema for n, df in found.items()}, defined, values), defined

    def plan():
        found = frames()
        cols, _ = columns(found)
        return found.pop("base"), found, specs.registry(cols), cols

    def selected() -> dict | None:
        """The manifest of the selection; features that it doesn't keep go no further."""
        if args.selection:
            return json.loads(read_text(spark, args.selection))
        if args.all_features or getattr(args, "keep", None):
            return None
        raise SystemExit("--selection names the manifest that `select` has written; --all-features takes all features instead")

    def kept(own):
        found = selected()
        return own if found is None else selection.kept_specs(own, found)

    def scans():
        modeling, split = spark.read.parquet(args.modeling), spark.read.parquet(args.labels)
        found = selected()
        return modeling, split, args.keep or (selection.kept_names(found) if found else [c for c in modeling.columns if c not in BASE])

    match args.command:
        case "list-tables":
            return [{"table": t.name, "files": len(t.paths), "columns": t.columns} for t in tables.discover(spark, args.raw_dir)]
        case "inventory":
            return told(inventory.build_inventory(spark, args.raw_dir), args.output)
        case "init":
            return s.initialize()
        case "ingest":
            return {"run_id": s.ingest(args.raw_dir, args.table)}
        case "validate":
            return s.validate(args.raw_dir, args.table)
        case "reset":
            return s.reset(args.table)
        case "cleanup":
            return s.cleanup()
        case "quality":
            loaded = [r[0] for r in s.records("ingested_tables").where("status = 'success'").select("table_name").distinct().collect()]
            checks = profile.quality_checks(s.read("base"), {n: s.read(n) for n in sorted(loaded) if n != "base"})
            out = {"checks": [asdict(c) for c in checks], "summary": profile.status_counts(checks)}
            if args.output_dir:
                write_text(spark, f"{args.output_dir}/quality.md", f"# Checks of the raw tables\n\n{model.markdown([out['summary']])}\n{model.markdown(out['checks'])}")
            return told(out, args.output_dir and f"{args.output_dir}/quality.json")
        case "catalog":
            found = frames()
            cols, defined = columns(found, args.sample_values)
            frame = catalog.tables_frame(spark, {n: df.count() for n, df in found.items()})
            summaries = [r.asDict() for r in catalog.table_summaries(catalog.catalog_frame(spark, cols), frame).orderBy("logical_table").collect()]
            out = {"tables": summaries, "columns": [asdict(c) for c in cols], "coverage": profile.definition_coverage([c.column_name for c in cols], list(defined))}
            if args.output_dir:
                write_text(spark, f"{args.output_dir}/catalog.md", f"# Tables\n\n{model.markdown(summaries)}\n# Columns\n\n{model.markdown(out['columns'])}")
            return told(out, args.output_dir and f"{args.output_dir}/catalog.json")
        case "features" | "select":
            base, found, own, cols = plan()
            limit = None if args.full else args.smoke_limit
            wide = assemble.assemble(base, found, own, limit=limit)
            if args.command == "select":
                decisions = selection.select_features(selection.specs_frame(spark, own), catalog.catalog_frame(spark, cols), selection.feature_stats(wide, [x.feature_name for x in own]))
                out = told(selection.manifest(decisions) | {"smoke_limit": limit}, args.selection)
                if args.execute:
                    s.write(assemble.assemble(base, found, selection.kept_specs(own, out), limit=limit), "compact")
                return {"decisions": out["features"], "kept": out["decision_counts"]["keep"]}
            if args.execute:
                s.write(wide, "layer")
            return {"feature_count": len(own), "feature_counts_by_family": specs.family_counts(own), "storage_estimate_bytes": specs.estimated_bytes(limit or base.count(), len(own) + 5)}
        case "export" | "validate-export":
            base, found, own, _ = plan()
            e = export.Exporter(spark, args.output, None if args.full else args.smoke_limit, args.compression)
            if args.command == "validate-export":
                return e.validate(assemble.base_frame(base, e.smoke_limit).count(), kept(own))
            return e.run(base, found, kept(own), args.family, force=args.force)
        case "join":
            base, _, own, _ = plan()
            e, wanted = export.Exporter(spark, args.output, None if args.full else args.smoke_limit), kept(own)
            export.write_checked(e.joined([x.feature_name for x in wanted]), args.modeling)
            return export.validate_joined(spark.read.parquet(args.modeling), assemble.base_frame(base, e.smoke_limit), wanted).first().asDict()
        case "split":
            labels = spark.read.parquet(args.modeling).select(*BASE)
            split, b = temporal.temporal_split(labels)
            export.write_checked(split, args.labels)
            return told(temporal.config(b, split, labels), args.output)
        case "train":
            limits = (None, None) if args.full else (args.train_row_limit, args.eval_row_limit)
            out = model.run_baseline(*scans(), class_weight=weight(args.class_weight), train_limit=limits[0], eval_limit=limits[1], iterations=args.iterations)
            if args.output_dir:
                model.write_artifacts(spark, out, args.output_dir)
            return {k: out[k] for k in ("metadata", "metrics")}
        case "diagnose":
            return told(model.weight_diagnostic(*scans(), weights=[weight(w) for w in args.class_weight or ("none", "3", "5", "balanced")], train_limit=args.train_row_limit, iterations=args.iterations), args.output)
        case "benchmark":
            return told(model.throughput(*scans(), row_limit=args.train_row_limit), args.output)
        case "compare":
            if args.artifact_dir:
                if not (args.name and args.labels):
                    raise SystemExit("--artifact-dir needs --name and --labels")
                record = registry.from_artifacts(spark, args.name, args.artifact_dir, temporal.checked_diagnostics(spark.read.parquet(args.labels)), role=args.role)
                found = registry.write(spark, args.registry, record, official=args.official)
            elif exists(spark, args.registry):
                found = json.loads(read_text(spark, args.registry))
            else:
                raise SystemExit(f"no registry at {args.registry}; --artifact-dir adds a first record")
            return registry.comparison(found, args.split)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    print(json.dumps(run(args, build_session()), indent=2, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
