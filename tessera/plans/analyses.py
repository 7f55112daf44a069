"""The four analyses end to end on their own input files.

These are the user-facing entry points: each reads the raw files the
analysis starts from (gzip log text, headerless particle CSV, headered
claims CSV, ratings / genome CSVs), runs the operators of this package and
returns DataFrames (nothing is collected). The registered queries in the
sibling modules exercise the same operators on stand-ins derived from the
test tables.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import encode as E
from tessera.operators import logs as L
from tessera.operators import metrics as MT
from tessera.operators import models as M
from tessera.operators import recommend as R
from tessera.operators.split import assign_folds, hash_sample, hash_split, train_test
from tessera.operators.tandem import gate
from tessera.session import ensure_checkpoint_dir, releasing
from tessera.sources import files
from tessera.plans.models import FOREST_GRID, GBT_GRID
from tessera.sources.tables import fit_layout

# Column names of the particle CSV (label, then 28 features).
PARTICLE_COLUMNS = [
    "labels", "lepton_pT", "lepton_eta", "lepton_phi", "missing_energy_magnitude",
    "missing_energy_phi", "jet_1_pt", "jet_1_eta", "jet_1_phi", "jet_1_b_tag", "jet_2_pt",
    "jet_2_eta", "jet_2_phi", "jet_2_b-tag", "jet_3_pt", "jet_3_eta", "jet_3_phi",
    "jet_3_b-tag", "jet_4_pt", "jet_4_eta", "jet_4_phi", "jet_4_b-tag", "m_jj", "m_jjj",
    "m_lv", "m_jlv", "m_bb", "m_wbb", "m_wwbb",
]


# --- web logs -----------------------------------------------------------------

def web_log_report(spark: SparkSession, path: str, month: str = "Jul", year: int = 1995,
                   top_n: int = 20) -> dict[str, DataFrame]:
    """Requests per 4-hour band (averages per observed and per calendar day),
    requests per day and the most requested .html files of one month."""
    lines = files.read_lines(spark, path)
    parsed = L.parse_access_log(lines, month, year)
    # days and bands both come from the same (tiny) band-day cells: one parse
    # and a checkpoint, so that the two reports do not parse the log again
    ensure_checkpoint_dir(spark)
    cells = L.band_day_cells(parsed).checkpoint(eager=True)
    return {
        "counts": L.log_filter_counts(lines, month, year),
        "daily": L.daily_counts(parsed, cells),
        "bands": L.hour_band_averages(parsed, cells),
        "top_files": L.top_files(L.month_lines(lines, month, year), top_n),
    }


# --- particle classification ---------------------------------------------------

def read_particles(spark: SparkSession, path: str, names: list[str] = PARTICLE_COLUMNS) -> DataFrame:
    """Headerless particle CSV: label (float text) -> int, features -> double,
    and ``row_key``, a 64-bit hash of the line's fields, as the key of hash
    splits (the file has no id; one key column also keeps filter
    expressions small for the optimizer)."""
    ensure_checkpoint_dir(spark)  # boosted trees checkpoint their lineage there
    raw = files.read_positional_csv(spark, path, names)
    label, feats = names[0], names[1:]
    return raw.select(F.xxhash64(*names).alias("row_key"),
                      F.col(label).try_cast("double").try_cast("int").alias("label"),
                      *[F.col(c).try_cast("double").alias(c) for c in feats])


def particle_classifier(spark: SparkSession, path: str, max_depth: int = 10, max_bins: int = 10,
                        max_iter: int = 20, train_fraction: float = 0.7) -> dict[str, DataFrame]:
    """Boosted trees on a 70/30 holdout: auc, accuracy, top-3 importances."""
    data = fit_layout(read_particles(spark, path), ["row_key"])
    feats = PARTICLE_COLUMNS[1:]
    train, test = train_test(data, ["row_key"], train_fraction, M.SEED)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                            M.gbt("label", max_depth, max_bins, max_iter)])
    with M.persisted(train):
        model = pipe.fit(train)
    imp = M.feature_importances(model.stages[-1], feats, spark)
    return {"report": M.binary_report(model.transform(test), "label"),
            "top_features": M.top_importances(imp, 3)}


def tuned_particle_models(spark: SparkSession, path: str, sample_fraction: float = 0.05,
                          folds: int = 5, parallelism: int = 2, max_depth: int = 10,
                          forest_grid: dict = FOREST_GRID, gbt_grid: dict = GBT_GRID) -> DataFrame:
    """Forest (trees x bins) and boosted trees (bins x iterations), each tuned
    by k-fold CV on a hash sample; best cell and held-out auc/accuracy."""
    feats = PARTICLE_COLUMNS[1:]
    data = fit_layout(hash_sample(read_particles(spark, path), ["row_key"], sample_fraction, M.SEED), ["row_key"])
    train, test = train_test(data, ["row_key"], 0.7, M.SEED + 1)  # independent of the sample draw
    rf = M.forest("label", max_depth=max_depth, max_bins=10, num_trees=20)
    gb = M.gbt("label", max_depth=max_depth, max_bins=5, max_iter=10)
    grids = {"forest": (rf, M.param_grid(rf, **forest_grid)),
             "gbt": (gb, M.param_grid(gb, **gbt_grid))}
    out = None
    for name, (est, grid) in grids.items():
        model, cells = M.cross_validate(train, feats, est, grid, ["row_key"], "label", folds=folds,
                                        seed=M.SEED + 2, parallelism=parallelism)
        best = M.grid_best(cells).select(F.lit(name).alias("model"), F.to_json("params").alias("params"),
                                         F.col("auc").alias("cv_auc"))
        row = M.side_by_side(best, M.binary_report(model.transform(test), "label"))
        out = row if out is None else out.unionByName(row)
    return out


# --- claims ----------------------------------------------------------------------

def claim_dictionaries(spark: SparkSession, csv_path: str, out_path: str,
                       top_n: int = E.DEFAULT_TOP_N, optional: tuple[str, ...] = ()) -> DataFrame:
    """Learn the claims dictionaries (top-N for large columns, full domain for
    string categories, fixed overrides) and save them partitioned by column."""
    raw = files.read_string_csv(spark, csv_path)  # no inference
    top_cols = C.columns_of(raw, ["Blind_Make", "Blind_Model", "Blind_Submodel", "Model_Year"], optional)
    ord_cols = C.columns_of(raw, C.STRING_CATEGORIES, optional)
    filled = C.fill_missing_category(raw, top_cols + ord_cols)
    forced, domains = E.reference_overrides(spark)
    mapping = E.apply_overrides(E.learn_dictionaries(filled, top_cols, ord_cols, top_n),
                                forced=forced, domains=domains)
    files.write_mapping(mapping, out_path)
    return files.read_mapping(spark, out_path)


def tandem_claims(spark: SparkSession, csv_path: str, dictionary_path: str, tree_depth: int = 20,
                  glm_iter: int = 50, reg_param: float = 0.01,
                  key: list[str] | None = None, optional: tuple[str, ...] = ()) -> DataFrame:
    """Two-part claim model: a tree decides zero / non-zero, a gamma GLM
    trained on actual claims predicts the amount of rows the tree lets
    through, every other row predicts 0. Returns rmse, mae on the test split.
    ``key`` (default: a hash of the whole line) feeds the hash split."""
    raw = files.read_string_csv(spark, csv_path)
    if not key:  # no id column: a 64-bit hash of the whole line
        raw, key = raw.withColumn("row_key", F.xxhash64(*raw.columns)), ["row_key"]
    ints, nums = C.columns_of(raw, C.INT_CATEGORIES, optional), C.columns_of(raw, C.NUMERIC_FEATURES, optional)
    cats = C.columns_of(raw, C.STRING_CATEGORIES + C.LARGE_CATEGORIES, optional)
    clean = C.clean_claims(raw, key, ints, nums, cats)
    enc = fit_layout(E.encode(clean, files.read_mapping(spark, dictionary_path), cats), key)
    data = hash_split(enc, key + ["y"], 0.7, M.SEED)
    categorical = ints + cats
    with M.persisted(data):
        train = data.filter(F.col("split") == "train")
        clf = M.fit_claim_gate(train, categorical, nums, max_depth=tree_depth)
        reg = M.fit_claim_severity(train.filter(F.col("y") == 1), categorical, nums,
                                   max_iter=glm_iter, reg_param=reg_param)
        test = data.filter(F.col("split") == "test")
        scored = reg.transform(clf.transform(test).drop("features"))
        final = scored.select(gate().alias("prediction"), "Claim_Amount")
        return MT.regression_metrics(final, "prediction", "Claim_Amount").checkpoint(eager=True)


# --- ratings ---------------------------------------------------------------------

def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with (at least) userId, movieId and rating, typed."""
    return files.read_named_csv(spark, path, {"userId": "bigint", "movieId": "bigint", "rating": "double"})


def rating_grid(spark: SparkSession, ratings_path: str, reg_params=(0.1, 0.5, 1.0),
                rank: int = 10, max_iter: int = 10, folds: int = 3,
                num_blocks: int | None = None) -> DataFrame:
    """ALS over folds x regParam; rmse/mae per fold with mean and std."""
    ensure_checkpoint_dir(spark)
    folded = assign_folds(read_ratings(spark, ratings_path), ["userId", "movieId"], folds, M.SEED)
    cells = M.als_grid(folded, tuple(reg_params), folds=folds, rank=rank, max_iter=max_iter,
                       num_blocks=num_blocks)
    return MT.fold_metric_matrix(cells, folds=folds)


def tag_clusters(spark: SparkSession, ratings_path: str, scores_path: str, tags_path: str,
                 k: int = 25, folds: int = 3, rank: int = 10, max_iter: int = 10,
                 num_blocks: int | None = None) -> DataFrame:
    """Per rating split alone: ALS item factors -> k-means -> the 3 biggest
    clusters' 3 strongest tags with their names."""
    ensure_checkpoint_dir(spark)
    folded = assign_folds(read_ratings(spark, ratings_path), ["userId", "movieId"], folds, M.SEED)
    scores = files.read_named_csv(spark, scores_path, {"movieId": "bigint", "tagId": "int", "relevance": "double"})
    tags = files.read_named_csv(spark, tags_path, {"tagId": "int", "tag": "string"})
    best = R.item_best_tag(scores).checkpoint(eager=True)  # used for each split, twice
    out = None
    with releasing(spark), M.persisted(folded):
        for split in range(1, folds + 1):
            assigned = M.item_clusters(folded.filter(F.col("fold") == split), k=k, rank=rank,
                                       max_iter=max_iter, num_blocks=num_blocks)
            top = (R.cluster_top_tags(assigned, best, tags)
                   .join(R.cluster_coverage(assigned, best), "prediction")
                   .withColumn("split", F.lit(split)))
            out = top if out is None else out.unionByName(top)
    return out
