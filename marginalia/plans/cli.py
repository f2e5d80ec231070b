"""Command line: run, hive, push, pull, status, clean, embed."""

from __future__ import annotations

import argparse
import glob
import os
import time

from pyspark.sql import SparkSession

from marginalia.functions.text import format_elapsed, format_number
from marginalia.operators.filters import WorkFilter, pending, since
from marginalia.plans import config as settings
from marginalia.plans import embed, ingest, layout, transfer
from marginalia.plans.state import RunState, append_log, now
from marginalia.sources import manifest

PREVIEW = 10


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="marginalia")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, about: str) -> argparse.ArgumentParser:
        c = commands.add_parser(name, help=about)
        c.add_argument("-o", "--output-dir", default="./outputs")
        c.add_argument("-c", "--config")
        return c

    run = command("run", "shards to raw tables")
    run.add_argument("--manifest", required=True)
    for flag in ("max-retries", "outer-retries", "retry-delay", "zstd-level", "max-shards"):
        run.add_argument(f"--{flag}", type=int)
    for flag, name in (("domain", "domains"), ("topic", "topics"), ("language", "languages"), ("work-type", "work_types")):
        run.add_argument(f"--{flag}", dest=name, action="append", default=[])
    for flag in ("require-abstract", "force", "dry-run", "hive", "clean-raw", "embed", "lenient"):
        run.add_argument(f"--{flag}", action="store_true")
    run.add_argument("--since")
    hive = command("hive", "raw tables to year and bucket partitions")
    for flag in ("zstd-level", "row-group-size", "num-shards"):
        hive.add_argument(f"--{flag}", type=int)
    for flag in ("force", "dry-run"):
        hive.add_argument(f"--{flag}", action="store_true")
    for name in ("push", "pull"):
        c = command(name, f"{name} outputs by difference")
        c.add_argument("--store", required=True, help="folder of the object store")
        c.add_argument("--prefix", default="")
        c.add_argument("--concurrency", type=int)
        for flag in ("no-raw", "no-hive", "dry-run", "force"):
            c.add_argument(f"--{flag}", action="store_true")
    status = command("status", "listing and progress")
    status.add_argument("--manifest", required=True)
    command("clean", "remove temporary files")
    vectors = command("embed", "vectors of works, incrementally")
    vectors.add_argument("--backend", choices=["http", "onnx", "hash"], default="http")
    vectors.add_argument("--endpoint")
    vectors.add_argument("--model")
    vectors.add_argument("--model-dir")
    vectors.add_argument("--dim", type=int, default=64)
    for flag in ("batch-size", "max-rows"):
        vectors.add_argument(f"--{flag}", type=int)
    vectors.add_argument("--force", action="store_true")
    return top


def _run(spark: SparkSession, args: argparse.Namespace, c: settings.Config, output: str) -> int:
    raw, snapshot = os.path.join(output, "raw"), os.path.join(output, manifest.SNAPSHOT_NAME)
    told = WorkFilter(args.domains, args.topics, args.languages, args.work_types, args.require_abstract)
    work_filter = c.filter.merged(told)
    old = manifest.read_snapshot(spark, snapshot)
    shards = manifest.stabilise(manifest.read_manifest(spark, args.manifest), old)
    done = ingest.completed_shards(spark, raw)
    changed = manifest.diff(old, shards, done)
    gone = [r["shard_idx"] for r in changed.where("change = 'removed'").collect()]
    due = shards if args.force else shards.join(changed.where("change in ('changed', 'unchanged_missing')").select("url"), "url", "left_semi")
    due = since(due, args.since) if args.since else due
    todo = pending(due, done.limit(0), most=args.max_shards).cache()
    rows = todo.orderBy("shard_idx").limit(PREVIEW).collect()
    count = todo.count()
    print(f"{count} shards to process" + "".join(f"\n  {r['shard_idx']}: {r['url']}" for r in rows) + (f"\n  ... and {count - PREVIEW} more" if count > PREVIEW else ""))
    if args.dry_run:
        return 0
    state = RunState.load(output)
    state.started_at = now()
    ingest.delete_shards(raw, gone)
    failed, began = [], time.time()
    if count:
        # a further attempt at a shard is a further pass over the failed ones
        passes = settings.setting("outer_retries", args.outer_retries, c.outer_retries) + (args.max_retries or c.max_retries or 0)
        delay = settings.setting("retry_delay", args.retry_delay, c.retry_delay)
        options = {"work_filter": work_filter, "strict": not args.lenient, "zstd_level": settings.setting("zstd_level", args.zstd_level, c.zstd_level)}
        metrics, failed = ingest.ingest_isolated(spark, todo, raw, passes, lambda _: time.sleep(delay), **options)
        written = sum(r["written"] for r in metrics)
        print(f"{format_number(written)} of {format_number(sum(r['scanned'] for r in metrics))} records kept in {format_elapsed(time.time() - began)}")
        dates = sorted({r["updated_date"] for r in todo.select("updated_date").collect() if r["updated_date"]})
        numbers = [r["shard_idx"] for r in todo.select("shard_idx").collect() if r["shard_idx"] not in failed]
        append_log(output, {"shards_processed": numbers, "shards_removed": gone, "updated_dates": dates, "rows_written": written, "failed": len(failed)})
        state.completed_shards = sorted({*state.completed_shards, *numbers} - {*gone, *failed})
        per = {r["oa_shard_idx"]: r for r in metrics}
        outcomes = spark.createDataFrame([(n, n not in failed, per.get(n, {}).get("written", 0), per.get(n, {}).get("scanned", 0)) for n in [*numbers, *failed]], "shard_idx int, ok boolean, rows long, scanned long")
        print("run:", manifest.run_summary(outcomes).first().asDict())
        state.last_sync_date = dates[-1] if dates else state.last_sync_date
    # only shards that are whole now are known to the next run
    manifest.save_snapshot(manifest.gather(shards, ingest.completed_shards(spark, raw)), snapshot)
    state.manifest_shard_count, state.finished_at, state.filter = shards.count(), now(), vars(work_filter)
    state.save(output)
    if failed:
        print(f"failed shards: {failed}; later stages wait for a run without failures")
        return 1
    if args.hive or c.hive.is_enabled():
        layout.build_layout(spark, raw, os.path.join(output, "hive"), snapshot, c.hive.zstd_level or 8, c.hive.row_group_size or 500_000, c.hive.num_shards or 4)
        if args.embed or c.embed.is_enabled():
            _embed(spark, parser().parse_args(["embed", "-o", output]), c, output)
        if args.clean_raw or c.hive.clean_raw:
            # the layout is made of all raw shards, so the next run reads them again
            ingest.delete_shards(raw, [r["shard_idx"] for r in shards.select("shard_idx").collect()])
    return 0


def _embed(spark: SparkSession, args: argparse.Namespace, c: settings.Config, output: str) -> int:
    e = c.embed
    backend = e.backend or args.backend  # a backend in the file stands before the option, unlike all else
    dim, endpoint, model, folder = args.dim, args.endpoint or e.endpoint, args.model or e.model, args.model_dir or e.model_dir
    make = {"http": lambda: embed.HttpEmbedder(endpoint, model, dim), "onnx": lambda: embed.OnnxEmbedder(folder, dim, e.pooling, e.prompt, e.max_length or 512), "hash": lambda: embed.HashEmbedder(dim)}[backend]
    target = e.output or os.path.join(output, "embeddings")
    embed.run_embed(spark, os.path.join(output, "hive"), target, make, args.force, args.batch_size or e.batch_size or 64, args.max_rows or e.max_rows)
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    c = settings.load(args.config)
    output = c.output or args.output_dir  # an output in the file stands before the option
    if args.command == "clean":
        print(f"{ingest.clean_temporary(os.path.join(args.output_dir, 'raw'))} temporary files removed")
        return 0
    spark = spark or SparkSession.builder.appName("marginalia").getOrCreate()
    if args.command == "run":
        return _run(spark, args, c, output)
    if args.command == "hive":
        h = c.hive
        written = layout.build_layout(spark, os.path.join(output, "raw"), os.path.join(output, "hive"), os.path.join(output, manifest.SNAPSHOT_NAME), args.zstd_level or h.zstd_level or 8, args.row_group_size or h.row_group_size or 500_000, args.num_shards or h.num_shards or 4, args.force, args.dry_run)
        print("tables: " + (", ".join(written) or "none, up to date"))
        return 0
    if args.command in ("push", "pull"):
        subs = tuple(s for s, off in (("raw", args.no_raw), ("hive", args.no_hive)) if not off)
        done = transfer.sync(spark, output, transfer.FolderStore(args.store), args.prefix, args.command == "pull", subs, args.force or bool(c.upload.force), args.dry_run, args.concurrency or c.upload.concurrency or 8)
        print(done)
        return 1 if done.files_failed else 0
    if args.command == "status":
        shards = manifest.read_manifest(spark, args.manifest)
        print(manifest.summary(shards).first().asDict(), f"complete: {ingest.completed_shards(spark, os.path.join(output, 'raw')).count()}", f"files: {len(glob.glob(os.path.join(output, 'raw', '**', '*.parquet'), recursive=True))}")
        return 0
    return _embed(spark, args, c, output)


if __name__ == "__main__":
    raise SystemExit(main())
