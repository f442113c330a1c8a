"""Command line: python -m sieveline measure PATH | diff SOURCE TARGET [--key a,b] [--detail FOLDER]."""

from __future__ import annotations

import argparse
import json

from sieveline.operators import diff, fingerprint, keys, profile, rules
from sieveline.session import local_session
from sieveline.sources import scans, sinks


def main() -> None:
    parser = argparse.ArgumentParser(prog="sieveline", description=__doc__)
    parts = parser.add_subparsers(dest="what", required=True)
    measure = parts.add_parser("measure")
    measure.add_argument("path")
    compare = parts.add_parser("diff")
    compare.add_argument("source")
    compare.add_argument("target")
    compare.add_argument("--key", type=lambda x: x.split(","))
    compare.add_argument("--detail")
    args = parser.parse_args()
    spark = local_session()

    def read(path: str):
        df, _, errors = scans.read_any(spark, path)
        if df is None:
            parser.error(f"{path}: {errors}")
        return df

    if args.what == "measure":
        df = read(args.path)
        out = {"fingerprint": fingerprint.dataset_fingerprint(df), "nulls": profile.nulls(df), "derived": profile.derived(df), "rules": rules.integrity(df).unionByName(rules.schema_rules(df)), "contract": rules.contract(df)}
    else:
        s, f = read(args.source), read(args.target)
        key = keys.discover(s, f, args.key)
        if key.columns is None:
            only = diff.multiset(s, f)
            out = {"only_source": only[0].groupBy().count(), "only_target": only[1].groupBy().count()}
        else:
            d = diff.Diff(s, f, key.columns)
            out = {"summary": d.summary(), "patterns": d.patterns()}
            if args.detail:
                sinks.detail(d, args.detail)
        print(json.dumps({"key": key.columns, "origin": key.origin, "notes": key.notes}))
    print(json.dumps({k: sinks.report(v) for k, v in out.items()}, indent=1, default=str, ensure_ascii=False))


if __name__ == "__main__":
    main()
