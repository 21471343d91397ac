"""Commands: schema, normalize, refresh, validate, graph, diff, gates."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry import schema
from quarry.operators import diff, graph, validate
from quarry.plans import refresh
from quarry.sources import dictionaries, envelopes, harvest, normalizers
from quarry.vocab import DOMAINS


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quarry", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("schema")
    s.add_argument("--markdown", action="store_true")
    for name in ("normalize", "refresh"):
        c = sub.add_parser(name)
        c.add_argument("raw")
        c.add_argument("out")
        c.add_argument("--sources", default=",".join(normalizers.REGISTRY))
        if name == "refresh":
            c.add_argument("--failed", default="")
            c.add_argument("--day")
            c.add_argument("--terms", help="a JSON file of term tables")
    h = sub.add_parser("harvest")
    h.add_argument("out")
    h.add_argument("--modules", required=True, help="modules with a HARVESTER, by commas")
    h.add_argument("--fetch", required=True, help="module:function that takes an address and gives (status, body)")
    h.add_argument("--fast", action="store_true")
    h.add_argument("--limit", type=int)
    e = sub.add_parser("enrich")
    e.add_argument("raw")
    e.add_argument("out")
    e.add_argument("--sources", default=",".join(normalizers.REGISTRY))
    e.add_argument("--terms")
    u = sub.add_parser("check-urls")
    u.add_argument("root")
    u.add_argument("--head", required=True, help="module:function that takes an address and gives (status, final address)")
    for name in ("validate", "graph", "diff", "gates"):
        sub.add_parser(name).add_argument("root")
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "schema":
        print(schema.markdown() if args.markdown else json.dumps(schema.json_schema(), indent=2, sort_keys=True))
        return 0
    spark = spark or SparkSession.builder.appName("quarry").getOrCreate()
    names = [s for s in getattr(args, "sources", "").split(",") if s]
    if args.command == "normalize":
        if set(names) - set(normalizers.REGISTRY):
            return refresh.MISCONFIGURED
        records, excluded = normalizers.split(normalizers.normalize_all(envelopes.read_envelopes(spark, args.raw), names))
        envelopes.write_split(records, f"{args.out}/records")
        envelopes.write_jsonl(excluded, f"{args.out}/excluded", ("native_id", "reason"))
        return 0
    if args.command == "harvest":
        found, errors = harvest.discover(args.modules.split(","))
        for name, wrong in errors.items():
            print(f"{name}: {wrong}")
        fetch, failed = harvest.Polite(harvest.resolve(args.fetch)), 0
        for source, one in sorted(found.items()):
            try:
                one.probe(fetch)
                one.harvest(spark, fetch, args.fast, args.limit).write.mode("overwrite").json(f"{args.out}/{source}")
            except harvest.HarvestError as wrong:
                failed += 1
                print(f"{source}: {wrong}")
        return refresh.OK if found and not failed and not errors else refresh.ALL_FAILED if failed == len(found) else refresh.INVALID
    if args.command == "enrich":
        raw = envelopes.read_envelopes(spark, args.raw)
        records, _ = normalizers.split(normalizers.normalize_all(raw, names))
        texts = [normalizers.REGISTRY[s][1](raw.where(F.col("source") == s)).withColumn("source", F.lit(s)) for s in names]
        out = refresh.apply_rules(records, reduce(lambda a, b: a.unionByName(b), texts), dictionaries.load(args.terms) if args.terms else dictionaries.DEFAULT)
        envelopes.write_split(out, args.out)
        return refresh.OK
    if args.command == "refresh":
        out = refresh.run(spark, envelopes.read_envelopes(spark, args.raw), args.out, dictionaries.load(args.terms) if args.terms else None, failed=[s for s in args.failed.split(",") if s], sources=names, day=args.day)
        print(out.changelog or f"errors: {out.errors}, warnings: {out.warnings}")
        return out.code
    store = envelopes.Snapshots(spark, f"{args.root}/catalog")
    rows = store.read()
    if rows is None:
        print("no catalog")
        return refresh.MISCONFIGURED
    if args.command == "check-urls":
        for r in envelopes.status_histogram(envelopes.probe(rows.select("url").where("url IS NOT NULL"), harvest.resolve(args.head))).orderBy("status").collect():
            print(f"{r['status']}: {r['n']}")
        return refresh.OK
    if args.command == "validate":
        found = refresh.check(rows)
        kinds = found.groupBy("severity", "message").count()
        for r in kinds.orderBy("severity", "message").limit(200).collect():
            print(f"{r['severity']}: {r['message']}: {r['count']}")
        if (more := kinds.count() - 200) > 0:
            print(f"… and {more} more kinds of message")
        return refresh.INVALID if found.where("severity = 'error'").limit(1).count() else refresh.OK
    if args.command == "graph":
        g = refresh.graph_rows(rows)
        nodes, edges = graph.nodes(g, DOMAINS), graph.links(g, DOMAINS)
        bad = graph.contract_errors(nodes, edges, g).count()
        print(f"nodes: {nodes.count()}, links: {edges.count()}, contract errors: {bad}")
        return refresh.INVALID if bad else refresh.OK
    if args.command == "diff":
        versions = store.versions()
        old = store.read(versions[-2]) if len(versions) > 1 else rows.limit(0)
        found = diff.diff(old, rows, ("raw_hash",))
        counts = {k: int(v or 0) for k, v in diff.diff_counts(old, rows, found).first().asDict().items()}
        print(diff.render(found, counts, versions[-1]))
        return refresh.OK
    n = rows.agg(F.count("*").alias("records")).first()
    errors = refresh.check(rows).where("severity = 'error'").count()
    result = validate.gates({"records": n["records"], "errors": errors}, {"records": (">=", 1), "errors": ("<=", 0)})
    for name, status, detail in result:
        print(f"{status} {name}: {detail}")
    return refresh.OK if all(s == "PASS" for _, s, _ in result) else refresh.INVALID


if __name__ == "__main__":
    sys.exit(main())
