import glob

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from tidepanel.plans import clean as stage
from tidepanel.plans import explore
from tidepanel.sources import readers, writers
from tidepanel.spec import ENERGY
from tidepanel.workload import tables


def test_raw_text_round_trip(spark, sf_dir, tmp_path):
    raw = tables.raw_panel(spark, sf_dir)
    writers.write_csv(raw, f"{tmp_path}/raw", sep=";")
    named = readers.read_raw(spark, f"{tmp_path}/raw")
    typed = readers.read_raw(spark, f"{tmp_path}/raw", raw.columns)
    assert named.columns == raw.columns and {t for _, t in named.dtypes} == {"string"}
    assert typed.exceptAll(raw).count() == 0 and typed.count() == raw.count()


def test_panel_csv_and_parquet(spark, sf_dir, tmp_path):
    panel = tables.clean_panel(spark, sf_dir)
    schema = readers.clean_schema()
    assert sorted(schema.fieldNames()) == sorted(panel.columns) and len(schema) == 40
    assert dict(panel.dtypes) == {f.name: f.dataType.simpleString() for f in schema}
    ordered = panel.select(*schema.fieldNames())
    writers.write_panel(ordered, f"{tmp_path}/csv", fmt="csv")
    back = readers.read_panel(spark, f"{tmp_path}/csv", "csv")
    assert back.exceptAll(ordered).count() == 0 and back.count() == ordered.count()
    writers.write_panel(ordered, f"{tmp_path}/pq")
    again = readers.read_panel(spark, f"{tmp_path}/pq")
    assert again.columns == ordered.columns and again.dtypes == ordered.dtypes
    plan = again.where("Region = 'view'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Region), EqualTo(Region,view)]" in plan


def test_entities_that_look_like_numbers_stay_text(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES ('01', TIMESTAMP_NTZ'2024-01-01 00:00:00', 1.5D), ('7', TIMESTAMP_NTZ'2024-01-01 01:00:00', 2.5D) AS t(Region, Datetime, Consommation_MW)")
    writers.write_panel(rows, f"{tmp_path}/p")
    back = readers.read_panel(spark, f"{tmp_path}/p")
    assert back.dtypes == rows.dtypes and {r["Region"] for r in back.collect()} == {"01", "7"}


def test_reports(spark, sf_dir, tmp_path):
    raw = tables.raw_panel(spark, sf_dir)
    text = writers.null_report(raw)
    assert "null cells" in text and f"Column 30: {raw.count():,}" in text
    writers.write_text(raw, text, f"{tmp_path}/report")
    assert open(glob.glob(f"{tmp_path}/report/part-*")[0], encoding="utf-8").read() == text
    panel = stage.clean(raw)
    summary = writers.exploration_report(explore.exploration_report(panel))
    assert "9 variables of 5 entities" in summary
    assert "no column" in writers.null_report(panel.select("Region"))


def test_pipeline_is_stored_under_its_name(spark, tmp_path):
    df = spark.createDataFrame([(1.0,)], "x double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="v")]).fit(df)
    path = writers.save_pipeline(model, str(tmp_path), "Random Forest")
    assert path.endswith("best_model_Random_Forest")
    assert PipelineModel.load(path).transform(df).first()["v"][0] == 1.0


def test_profile_and_head(spark, sf_dir, tmp_path):
    panel = tables.clean_panel(spark, sf_dir)
    writers.write_profile(panel.select("Region", "Season"), f"{tmp_path}/meta")
    assert spark.read.option("header", True).csv(f"{tmp_path}/meta").count() == 2
    head = writers.panel_head(panel, ENERGY, 10).collect()
    assert len(head) == 10 and head[0]["Region"] == "click"


def test_exploration_tables(spark, sf_dir):
    panel = tables.stored_clean_panel(spark, sf_dir)
    found = explore.explore(panel)
    assert found["yearly"].count() == 1 and found["hourly"].count() == 24
    assert found["box_Balance_MW"].count() == 5 and found["violin_Eolien_MW"].count() == 500
    maps = explore.null_maps(tables.raw_panel(spark, sf_dir), panel)
    assert maps["before_after"].where("stage = 'after'").first()["completeness"] <= 100
    assert explore.correlations(panel)["top_pairs"].count() == 15


def test_columns_by_name_pattern(spark):
    from tidepanel.spec import name_matches
    df = spark.createDataFrame([(1, 2, 3, 4)], "`a (MW)` int, `TCO x (%)` int, batterie int, other int")
    assert name_matches(df, ("(MW)", "(%)", "TCO", "TCH", "batterie")) == ["a (MW)", "TCO x (%)", "batterie"]


def test_tables_go_to_the_named_folder():
    import pytest

    from tidepanel import session

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Fake:
        def __init__(self, set_by_call=None, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})
            self.sparkContext = type("Context", (), {"getCheckpointDir": lambda _: set_by_call})()

    assert session.shared_folder(Fake(spark_checkpoint_dir="hdfs://x/y/", spark_master="yarn")) == "hdfs://x/y"
    assert session.shared_folder(Fake("hdfs://x/z", spark_master="yarn")) == "hdfs://x/z"
    for master in ("yarn", "local[2]", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.shared_folder(Fake(spark_master=master))
    assert session.is_one_machine(Fake(spark_master="local[2]"))
    assert not session.is_one_machine(Fake(spark_master="local-cluster[2,1,1024]"))
