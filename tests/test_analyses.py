"""End-to-end analyses on their own file formats, written from the sf0.001
stand-ins into a temporary folder."""

from pyspark.sql import functions as F

from tessera.plans import analyses as A
from tessera.plans import logs as LQ
from tessera.sources import files
from tessera.sources.fixtures import access_log, claims, genome_scores, genome_tags, particles
from tests.conftest import SF_SMALL


def test_web_log_report_matches_registered_query(spark, tmp_path):
    path = str(tmp_path / "log")
    files.write_lines(access_log(spark, SF_SMALL), path)
    rep = A.web_log_report(spark, path, month="Jan", year=2024)
    got = sorted(tuple(r) for r in rep["bands"].collect())
    want = sorted(tuple(r) for r in LQ.log_hour_bands(spark, SF_SMALL).collect())
    assert got == want and rep["top_files"].count() == 20


def test_particle_classifier_on_headerless_csv(spark, tmp_path):
    path = str(tmp_path / "particles")
    p = particles(spark, SF_SMALL)
    cols = [F.col("label_signal").cast("double").cast("string")] + [F.col(f"f{i}").cast("string") for i in range(1, 29)]
    files.write_csv(p.select(*cols), path, header=False)
    out = A.particle_classifier(spark, path, max_depth=3, max_iter=3)
    r = out["report"].first()
    assert r.auc > 0.8 and 0 < r.n_test < 500
    assert set(x.feature for x in out["top_features"].collect()) <= set(A.PARTICLE_COLUMNS[1:])


def test_claims_dictionary_and_tandem_model(spark, tmp_path):
    csv, dic = str(tmp_path / "claims"), str(tmp_path / "dict")
    raw = claims(spark, SF_SMALL).drop("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    raw.write.option("header", True).csv(csv)  # as other tools write it: NULL is an empty field
    mapping = A.claim_dictionaries(spark, csv, dic)
    sizes = {r.column_name: r.n for r in mapping.groupBy("column_name").agg(F.count("*").alias("n")).collect()}
    assert sizes["Blind_Make"] <= 20 and sizes["Cat12"] == 4 and sizes["Blind_Submodel"] == 21
    r = A.tandem_claims(spark, csv, dic, tree_depth=3, glm_iter=5).first()
    assert r.rmse >= r.mae >= 0 and r.n_scored > 0


def test_ratings_grid_and_tag_clusters(spark, tmp_path):
    from tessera.sources.fixtures import ratings
    rp, sp, tp = str(tmp_path / "r"), str(tmp_path / "s"), str(tmp_path / "t")
    files.write_csv(ratings(spark, SF_SMALL), rp)
    files.write_csv(genome_scores(spark, SF_SMALL), sp)
    files.write_csv(genome_tags(spark, SF_SMALL), tp)
    grid = A.rating_grid(spark, rp, rank=2, max_iter=2).collect()
    assert len(grid) == 3 and all(g.mean_rmse >= g.mean_mae for g in grid)
    tags = A.tag_clusters(spark, rp, sp, tp, k=4, rank=2, max_iter=2)
    rows = tags.collect()
    assert rows and all(1 <= r.rank <= 3 and r.split in (1, 2, 3) for r in rows)


def test_tuned_particle_models_small_grid(spark, tmp_path):
    path = str(tmp_path / "particles")
    p = particles(spark, SF_SMALL)
    cols = [F.col("label_signal").cast("double").cast("string")] + [F.col(f"f{i}").cast("string") for i in range(1, 29)]
    files.write_csv(p.select(*cols), path, header=False)
    out = A.tuned_particle_models(spark, path, sample_fraction=1.0, folds=2, max_depth=2,
                                  forest_grid={"numTrees": [2, 4]}, gbt_grid={"maxIter": [2]}).collect()
    assert sorted(r.model for r in out) == ["forest", "gbt"]
    assert all(0.5 < r.cv_auc <= 1.0 and 0 < r.n_test for r in out)


def test_web_log_report_month_invariants(spark, tmp_path):
    """28 of 31 July days present, one stray record from another month, one
    line without a timestamp: averages divide by 28 and by 31."""
    lines = []
    for d in [x for x in range(1, 32) if x not in (29, 30, 31)]:
        for h in (0, 5, 9, 13, 17, 22):
            lines.append(f'host - - [{d:02d}/Jul/1995:{h:02d}:00:00 -0400] "GET /a/b/page{d % 3}.html HTTP/1.0" 200 1')
    lines.append('host - - [31/Aug/1995:00:00:00 -0400] "GET /x.html HTTP/1.0" 200 1')
    lines.append('broken /Jul/1995 line')
    path = str(tmp_path / "nasa")
    files.write_lines(spark.createDataFrame([(v,) for v in lines], "value string"), path)
    rep = A.web_log_report(spark, path, month="Jul", year=1995)
    c = rep["counts"].first()
    assert (c.n_lines, c.n_month, c.n_unparsed) == (len(lines), len(lines) - 1, 1)
    bands = rep["bands"].collect()
    assert len(bands) == 6 and all(b.observed_days == 28 and b.calendar_days == 31 for b in bands)
    assert all(b.requests == 28 and b.avg_per_observed_day == 1.0 for b in bands)
    assert rep["daily"].count() == 28
    top = rep["top_files"].collect()
    # page1 on 10 days; page0 and page2 on 9 days each: tie broken by name
    assert [(t.file_name, t.requests) for t in top] == [("page1", 60), ("page0", 54), ("page2", 54)]


def test_write_report_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    files.write_lines(access_log(spark, SF_SMALL), path)
    rep = A.web_log_report(spark, path, month="Jan", year=2024)
    out = files.write_report({"bands": rep["bands"], "top_files": rep["top_files"]}, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(out["top_files"])
    assert back.count() == 20 and set(back.columns) == {"file_name", "requests"}
