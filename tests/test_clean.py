import datetime as dt
import json

from starloom.operators import clean as C
from starloom.sources import zones as Z

COLS = C.RAW_COLUMNS


def raw_row(**kw):
    base = {
        "incident_datetime": "2022-01-03T10:15:00.000", "report_datetime": "2022-01-03T11:00:00.000",
        "incident_id": "1", "report_type_description": "Initial", "incident_code": "7",
        "incident_category": "Larceny", "incident_subcategory": "Theft", "incident_description": "about",
        "resolution": "Open", "police_district": "Central", "intersection": "A ST \\ B ST", "cnn": "123",
        "latitude": "37.77", "longitude": "-122.4",
    }
    base.update(kw)
    return base


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in COLS) for r in rows], ", ".join(f"{c} string" for c in COLS))


def test_cleaning_filters_and_audit(spark):
    rows = [
        raw_row(incident_id="1"),
        raw_row(incident_id="2", police_district="Out of SF"),
        raw_row(incident_id="3", police_district="out of sf"),              # case-sensitive: kept
        raw_row(incident_id="4", report_type_description="Vehicle Supplement"),
        raw_row(incident_id="5", report_type_description="supplement"),      # case-sensitive: kept
        raw_row(incident_id="6", resolution=None),
        raw_row(incident_id="7", cnn="12x"),                                # malformed number
        raw_row(incident_id="8", incident_datetime="2021-12-31T23:59:00.000"),
    ]
    df = frame(spark, rows)
    kept = sorted(r.incident_id for r in C.clean_incidents(df, "2022-01-01").collect())
    assert kept == [1, 3, 5]
    audit = {r.outcome: r.n_rows for r in C.load_audit(df, "2022-01-01").collect()}
    assert audit == {"kept": 3, "excluded_district": 1, "supplement": 1, "null_value": 1, "malformed": 1,
                     "before_valid_date": 1}


def test_cleansed_types(spark):
    out = C.clean_incidents(frame(spark, [raw_row()]))
    types = dict(out.dtypes)
    assert "report_type_description" not in types
    assert types["incident_datetime"] == "timestamp_ntz" and types["incident_id"] == "bigint"
    assert types["cnn"] == "int" and types["latitude"] == "double"
    r = out.first()
    assert r.incident_datetime == dt.datetime(2022, 1, 3, 10, 15) and r.latitude == 37.77


def test_missing_column_is_an_error(spark):
    import pytest
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        C.project_columns(frame(spark, [raw_row()]).drop("cnn")).collect()


def test_json_array_input(spark, tmp_path):
    rows = [raw_row(incident_id=str(i), cnn=str(100 + i)) for i in range(5)]
    rows[2]["incident_code"] = 9          # an unquoted number in the payload
    p = tmp_path / "raw.json"
    p.write_text(json.dumps(rows, indent=2))
    df = Z.read_raw(spark, str(p), COLS, multi_line=True)
    assert df.count() == 5
    out = C.clean_incidents(df)
    assert sorted(r.incident_code for r in out.collect()) == [7, 7, 7, 7, 9]


def test_change_window_and_row_cap(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 1)), (2, dt.datetime(2021, 1, 1), dt.datetime(2022, 2, 1)),
         (3, dt.datetime(2021, 1, 1), dt.datetime(2021, 6, 1))], "id int, created_at timestamp_ntz, updated_at timestamp_ntz")
    assert sorted(r.id for r in Z.change_window(df, "2022-01-01").collect()) == [1, 2]
    assert [r.id for r in Z.row_cap(df, 2, ["id"]).collect()] == [1, 2]
    assert Z.row_cap(df, None, ["id"]).count() == 3


def test_size_gate(spark):
    import pytest
    df = spark.createDataFrame([("abc",), ("de",)], "s string")
    assert Z.size_gate(df, max_bytes=5) is df
    with pytest.raises(Z.SizeGateError):
        Z.size_gate(df, max_bytes=4)
