"""Fixed schemas and enumerations of the datasets, and projection of a DataFrame onto a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


# Column names, types and order of the published outputs.
DATASET = T.StructType(
    [
        _field("split", T.StringType()),
        _field("sequence", T.StringType()),
        _field("label", T.StringType()),
        _field("pair_id", T.StringType()),
        _field("category", T.StringType()),
        _field("scope", T.StringType()),
        _field("context_policy", T.StringType()),
        _field("chrom", T.StringType()),
        _field("start", T.LongType()),
        _field("end", T.LongType()),
        _field("strand", T.StringType()),
        _field("context_start", T.LongType()),
        _field("context_end", T.LongType()),
        _field("roi_start", T.IntegerType()),
        _field("roi_end", T.IntegerType()),
        _field("pool_start", T.IntegerType()),
        _field("pool_end", T.IntegerType()),
        _field("name", T.StringType()),
    ]
)
START_CODON_DATASET = T.StructType(
    [
        *DATASET,
        _field("transcript_id", T.StringType()),
        _field("gene_id", T.StringType()),
        _field("label_id", T.ByteType()),
        _field("delta_bp", T.LongType()),
    ]
)
STATISTICS = ("mean", "std", "frac_pos", "frac_neg", "mean_pos", "mean_neg")
SCORE_PREFIXES = ("phylop", "phylop_context")
SCORES = T.StructType([_field(f"{p}_{s}", T.FloatType()) for p in SCORE_PREFIXES for s in STATISTICS])
REGION = T.StructType(
    [
        _field("chrom", T.StringType()),
        _field("start", T.LongType()),
        _field("end", T.LongType()),
        _field("name", T.StringType()),
        _field("score", T.DoubleType()),
        _field("strand", T.StringType()),
        _field("category", T.StringType()),
        _field("ord", T.LongType()),
    ]
)
BED7 = T.StructType(
    [
        _field("chrom", T.StringType()),
        _field("start", T.LongType()),
        _field("end", T.LongType()),
        _field("name", T.StringType()),
        _field("score", T.DoubleType()),
        _field("strand", T.StringType()),
        _field("pair_id", T.StringType()),
    ]
)

# Enumerations of the published outputs.
CATEGORIES = ("repeats", "UCNE", "vista_enhancer", "promoters", "UTR5", "UTR3", "coding_regions", "exons", "introns", "upstream_TSS")
NONCODING = "noncoding_regions"
TEST_CONTIGS = ("chr2", "chr3", "chr16", "chr22")
DATASET_CONTIGS = (*(f"chr{i}" for i in range(1, 23)), "chrX")
AUTOSOMES = tuple(f"chr{i}" for i in range(1, 23))
ROLES = ("feature", "upstream", "random", "random-noannot")
CONTROLS = ROLES[1:]
POLICIES = ("causal", "symmetric")
CODON_LABELS = ("start", "noncoding_near", "noncoding_far", "inframe_methionine", "outframe_atg")

CONTEXT_LENGTH = 2048
KEPT_OF_LONG = 1000
FLANK_DISTANCE = 2000


def with_scores(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, *SCORES])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types, all nullable; missing ones are null, others go."""
    have = set(df.columns)
    columns = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    return df.sparkSession.createDataFrame([], schema).unionByName(df.select(*columns))
