"""The same model from CSV extracts as from the adapter's frames: file order stands in for the record number."""

from tradewind.plans.model import Model
from tradewind.sources import adapter
from tradewind.sources.csv import read_extracts, write_csv
from tradewind.sources.schemas import RAW_SCHEMAS


def test_clean_tables_from_csv(spark, sf_dir, tmp_path):
    read = adapter.extract_reader(spark, sf_dir)
    for name, schema in RAW_SCHEMAS.items():
        columns = spark.createDataFrame([], schema).columns
        raw = read(name)
        raw = raw.orderBy("ingest_seq") if "ingest_seq" in raw.columns else raw
        write_csv(raw.select(columns), f"{tmp_path}/{name}_raw.csv")
    extracts = {**read_extracts(spark, str(tmp_path)), "country": read("country")}
    domain = {"countries": adapter.VALID_CODES, "categories": adapter.CATEGORY_NAMES}
    from_csv, direct = Model.over(extracts, **domain), Model(read, **domain)
    for name in RAW_SCHEMAS:
        a, b = from_csv.staged(name), direct.staged(name)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert a.count() == b.count(), name
        assert a.exceptAll(b).count() == 0, name
