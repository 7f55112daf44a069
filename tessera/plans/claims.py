"""Registered claims queries: profiling, cleaning, dictionaries, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import encode as E
from tessera.session import scratch_path
from tessera.sources import files
from tessera.sources.fixtures import CLAIM_KEY, claims
from tessera.sources.tables import read_table

KEY = list(CLAIM_KEY)
# The columns that get top-N dictionaries (the string
# categories get full-domain ones).
TOPN_COLUMNS = ["Blind_Make", "Blind_Model", "Blind_Submodel", "Model_Year"]


def claim_columns(raw: DataFrame) -> dict[str, list[str]]:
    """The claim-model column families; a missing column is an error."""
    return {
        "int": C.columns_of(raw, C.INT_CATEGORIES),
        "numeric": C.columns_of(raw, C.NUMERIC_FEATURES),
        "string": C.columns_of(raw, C.STRING_CATEGORIES),
        "large": C.columns_of(raw, C.LARGE_CATEGORIES),
        # the cleaned table no longer has the makes and models
        "topn": C.columns_of(raw, TOPN_COLUMNS, optional=("Blind_Make", "Blind_Model")),
    }


def cleaned_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = claims(spark, sf_dir)
    c = claim_columns(raw)
    return C.clean_claims(raw, KEY, c["int"], c["numeric"], c["string"] + c["large"])


def learned_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-N ids for the large columns, ordinal ids for the string columns
    (missing values filled first), then the fixed overrides."""
    raw = claims(spark, sf_dir)
    c = claim_columns(raw)
    filled = C.fill_missing_category(raw, c["topn"] + c["string"])
    mapping = E.learn_dictionaries(filled, c["topn"], c["string"])
    forced, domains = E.reference_overrides(spark)
    # read once for the sizes and once for each encoded column
    return E.apply_overrides(mapping, forced=forced, domains=domains).checkpoint(eager=True)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims written as headered CSV to the shared folder and read back
    with an all-string schema (no inference)."""
    raw = claims(spark, sf_dir)
    path = scratch_path(spark, "claims-csv")
    files.write_csv(raw, path)
    return files.read_csv(spark, path, files.string_schema(raw.columns))


def text_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (line ends, quotes, commas, blanks) through CSV and back with
    a typed schema; line ends are escaped, so a file stays splittable."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "documents-csv")
    files.write_csv(docs, path, escaped=True)
    return files.read_csv(spark, path, docs.schema, escaped=True)


def encode_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Cat12 dictionary learned from rows without missing values: it has
    no missing category, so the replacement domain takes its place."""
    raw = claims(spark, sf_dir).filter(F.col("Cat12").isNotNull())
    _, domains = E.reference_overrides(spark)
    return E.apply_overrides(E.ordinal_mapping(raw, ["Cat12"]), domains=domains)


def label_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless positional CSV (label in float notation, then features):
    read as strings, renamed, label cast double -> int, features to double."""
    from tessera.sources.fixtures import particles
    p = particles(spark, sf_dir)
    names = ["vec_id", "label"] + [f"f{i}" for i in range(1, 29)]
    text = p.select(F.col("vec_id").cast("string"), F.col("label").cast("double").cast("string"),
                    *[F.col(n).cast("string") for n in names[2:]])
    path = scratch_path(spark, "particles-csv")
    files.write_csv(text, path, header=False)
    back = files.read_positional_csv(spark, path, names)
    return back.select(F.col("vec_id").try_cast("bigint").alias("vec_id"),
                       F.col("label").try_cast("double").try_cast("int").alias("label"),
                       *[F.col(n).try_cast("double").alias(n) for n in names[2:]])


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = claims(spark, sf_dir)
    return C.null_profile(raw, [c for c in raw.columns if c not in KEY])


def dropped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the claims table that the model projection leaves out."""
    raw = claims(spark, sf_dir)
    c = claim_columns(raw)
    kept = KEY + c["int"] + c["numeric"] + c["string"] + [C.CLAIM_TARGET] + c["large"]
    return C.dropped_profile(raw, kept)


def claims_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_claims(spark, sf_dir).drop("y")


def claim_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_claims(spark, sf_dir).select(*KEY, C.CLAIM_TARGET, "y")


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = claims(spark, sf_dir)
    c = claim_columns(raw)
    cols = c["string"] + [x for x in c["topn"] if x not in c["string"]]
    return E.category_counts(C.fill_missing_category(raw, cols), cols)


def distinct_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = claims(spark, sf_dir)
    c = claim_columns(raw)
    return E.distinct_categories(C.fill_missing_category(raw, c["string"]), c["string"])


def encode_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = claims(spark, sf_dir)
    c = claim_columns(raw)
    return E.top_n_mapping(C.fill_missing_category(raw, c["topn"]), c["topn"], n=E.DEFAULT_TOP_N)


def encode_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = claims(spark, sf_dir)
    c = claim_columns(raw)
    return E.ordinal_mapping(C.fill_missing_category(raw, c["string"]), c["string"])


def encode_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_mapping(spark, sf_dir)


def mapping_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.mapping_sizes(learned_mapping(spark, sf_dir))


def encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary saved as Parquet (partitioned by column), loaded back and
    applied to the cleaned claims: every feature a double."""
    path = scratch_path(spark, "claims-dictionary")
    files.write_mapping(learned_mapping(spark, sf_dir), path)
    mapping = files.read_mapping(spark, path)
    clean = cleaned_claims(spark, sf_dir)
    raw_cols = claim_columns(clean)
    return E.encode(clean, mapping, raw_cols["large"] + raw_cols["string"])


def stratified_split(spark: SparkSession, sf_dir: str, train_fraction: float = 0.7,
                     seed: int = 123) -> DataFrame:
    from tessera.operators.split import stratified_split as split
    return split(cleaned_claims(spark, sf_dir).select(*KEY, "y"), KEY, "y",
                 train_fraction, seed)


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "text_csv_roundtrip": text_csv_roundtrip,
    "label_cast": label_cast,
    "encode_domain": encode_domain,
    "null_profile": null_profile,
    "dropped_columns": dropped_columns,
    "claims_clean": claims_clean,
    "claim_indicator": claim_indicator,
    "category_counts": category_counts,
    "distinct_categories": distinct_categories,
    "encode_topn": encode_topn,
    "encode_ordinal": encode_ordinal,
    "encode_override": encode_override,
    "mapping_sizes": mapping_sizes,
    "encode_roundtrip": encode_roundtrip,
    "stratified_split": stratified_split,
}
