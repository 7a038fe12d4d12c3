"""Command lines of the pipelines: ``python -m stranda.commands regions|codons|scores|verify|compare``.

Each command is a function of a session and parsed arguments; only ``main`` creates and stops a session. Paths may be
remote. A command that finds something wrong ends with status 1.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .operators.checks import CheckError, differing_rows, schema_differences, validate
from .operators.windows import contig_lengths
from .plans import codons, functional
from .plans.annotate import annotate, annotate_in_place
from .schemas import AUTOSOMES, CONTROLS, DATASET, DATASET_CONTIGS, POLICIES, START_CODON_DATASET, with_scores
from .sources.bigwig import bigwig_contigs
from .sources.fasta import scan_fasta
from .sources.readers import scan_signal
from .sources.scratch import stored
from .sources.writers import standing, write_dataset

log = logging.getLogger("stranda")
#: How the policies are spelled in names of datasets.
SPELLED = {"symmetric": "bidi"}


def dataset_names(policies: Iterable[str] = POLICIES) -> dict[str, dict]:
    """What ``validate`` is told of each published dataset, by name."""
    found: dict[str, dict] = {}
    for policy in policies:
        end = SPELLED.get(policy, policy)
        for control in CONTROLS:
            found[f"functional-{control}-{end}"] = {"kind": "binary", "policy": policy, "control": control}
        for scope in ("full", "100bp"):
            found[f"functional-multiclass-{scope}-{end}"] = {"kind": "multiclass", "policy": policy, "scope": scope}
        found[f"atg-{end}"] = {"kind": "codon", "policy": policy}
    return found


def _plain(name: str) -> StructType:
    return START_CODON_DATASET if name.startswith("atg-") else DATASET


def _report(counts: dict[str, int], where: str) -> int:
    for name, n in sorted(counts.items()):
        log.info("wrote %d rows of %s to %s", n, name, where)
    return 0


def regions(spark: SparkSession, args: argparse.Namespace) -> int:
    """Functional regions, their controls and datasets."""
    options = functional.Options(
        limit_per_category=args.limit, seed=args.seed, include_noncoding=args.noncoding, attempts=args.attempts, exact=args.exact,
        skip_scores=args.track is None, skip_regions=args.keep_regions, skip_datasets=args.regions_only, contigs=tuple(args.contigs or DATASET_CONTIGS),
    )
    track = scan_signal(spark, args.track) if args.track else None
    return _report(functional.run(spark, args.data, args.regions, args.output, options, track), args.output)


def start_codons(spark: SparkSession, args: argparse.Namespace) -> int:
    """Start codons and their contrasts."""
    track = scan_signal(spark, args.track) if args.track else None
    counts = codons.run(
        spark, args.data, args.tables, args.output, args.examples, args.per_contig, args.seed, track, args.keep_tables,
        tuple(args.contigs or AUTOSOMES), args.exact,
    )
    return _report(counts, args.output)


def track_lengths(spark: SparkSession, track: str, genome: str | None) -> DataFrame:
    """(chrom, length) of a track: from the genome where it is given, from a bigWig file's own header otherwise."""
    if genome:
        return stored(contig_lengths(scan_fasta(spark, genome)), "lengths")
    if not track.lower().endswith((".bw", ".bigwig")):
        raise ValueError("only bigWig files name their contigs; give the genome for others")
    return spark.createDataFrame(list(bigwig_contigs(track).items()), "chrom string, length long")


def scores(spark: SparkSession, args: argparse.Namespace) -> int:
    """Statistics of a score track for datasets, below another folder or in their place."""
    if bool(args.output) == args.in_place:
        raise ValueError("give a folder for the output or ask for replacement, one of both")
    track, lengths, counts = scan_signal(spark, args.track), track_lengths(spark, args.track, args.genome), {}
    for path in args.datasets:
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if args.in_place:
            counts[path] = annotate_in_place(spark, path, track, lengths, args.exact).count()
            continue
        if name in counts:
            raise ValueError(f"two datasets are called {name}")
        rows = annotate(spark.read.parquet(standing(spark, path)), track, lengths, args.exact)
        counts[name] = write_dataset(rows, f"{args.output}/{name}", with_scores(_plain(name)))
    return _report(counts, args.output or "their own places")


def verify(spark: SparkSession, args: argparse.Namespace) -> int:
    """Check all datasets below a folder; every fault of every dataset is logged before the command ends."""
    bad = 0
    for name, told in dataset_names().items():
        schema = with_scores(_plain(name)) if args.scores else _plain(name)
        path = f"{args.root}/{name}.parquet"
        try:
            n = validate(spark.read.parquet(standing(spark, path)), schema, complete=not args.part, **told)
            log.info("%s: %d rows, nothing wrong", name, n)
        except CheckError as wrong:
            bad += 1
            log.error("%s: %s", name, wrong)
        except Exception as gone:  # Spark raises AnalysisException for a path that is not there
            if "PATH_NOT_FOUND" not in str(gone):
                raise
            bad += 1
            log.error("%s: not found at %s", name, path)
    return 1 if bad else 0


def compare(spark: SparkSession, args: argparse.Namespace) -> int:
    """Compare two datasets row by row, whatever their files and order; some rows that only one has are logged."""
    left, right = (spark.read.parquet(standing(spark, p)) for p in (args.left, args.right))
    if wrong := schema_differences(left, right.schema):
        log.error("%s", "; ".join(wrong))
        return 1
    found = differing_rows(left, right).persist()
    try:
        n = {r["side"]: r["count"] for r in found.groupBy("side").count().collect()}  # two sides
        for row in found.limit(args.show).collect():
            log.error("%s", row)
        log.info("%s", f"rows of one side only: {n}" if n else "no differences")
        return 1 if n else 0
    finally:
        found.unpersist()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="stranda", description=(__doc__ or "").split("\n")[0])
    commands = top.add_subparsers(dest="command", required=True)

    def command(run, name: str) -> argparse.ArgumentParser:
        made = commands.add_parser(name, help=(run.__doc__ or "").split("\n")[0], description=run.__doc__)
        made.set_defaults(run=run)
        return made

    def building(made: argparse.ArgumentParser) -> None:
        made.add_argument("--data", required=True, help="folder with genome.fa, gtfs and region_info")
        made.add_argument("--output", required=True, help="folder of the datasets")
        made.add_argument("--track", help="score track; without one there are no statistics")
        made.add_argument("--seed", type=int, default=42)
        made.add_argument("--contigs", nargs="+", help="contigs of the datasets")
        made.add_argument("--exact", action="store_true", help="repeat the random choices of published datasets, in part one after another")

    made = command(regions, "regions")
    building(made)
    made.add_argument("--regions", required=True, help="folder of the region tree")
    made.add_argument("--limit", type=int, default=10_000, help="regions of a category at most")
    made.add_argument("--attempts", type=int, default=2000, help="draws for a random control at most")
    made.add_argument("--noncoding", action="store_true", help="add the non-coding category")
    only = made.add_mutually_exclusive_group()
    only.add_argument("--keep-regions", action="store_true", help="build datasets from the region tree that is there")
    only.add_argument("--regions-only", action="store_true", help="build no datasets")

    made = command(start_codons, "codons")
    building(made)
    made.add_argument("--tables", required=True, help="folder of the label tables")
    made.add_argument("--examples", type=int, default=2000, help="examples in all")
    made.add_argument("--per-contig", type=int, default=10_000, help="transcripts of a contig at most; 0: all")
    made.add_argument("--keep-tables", action="store_true", help="take the label tables that are there")

    made = command(scores, "scores")
    made.add_argument("datasets", nargs="+", help="Parquet datasets")
    made.add_argument("--track", required=True, help="bigWig, bedGraph or Parquet")
    made.add_argument("--genome", help="FASTA file; contig lengths of tracks that are no bigWig files")
    made.add_argument("--output", help="folder of the datasets with statistics")
    made.add_argument("--in-place", action="store_true", help="replace the datasets")
    made.add_argument("--exact", action="store_true", help="single-precision values as published, bit for bit")

    made = command(verify, "verify")
    made.add_argument("--root", required=True, help="folder of the datasets")
    made.add_argument("--scores", action="store_true", help="datasets have statistics")
    made.add_argument("--part", action="store_true", help="datasets may lack contigs, splits and the non-coding category")

    made = command(compare, "compare")
    made.add_argument("left")
    made.add_argument("right")
    made.add_argument("--show", type=int, default=10, help="rows to log")
    return top


def main(argv: list[str] | None = None) -> int:
    from .session import session

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    args = parser().parse_args(argv)
    spark = session(f"stranda {args.command}")
    try:
        return args.run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
