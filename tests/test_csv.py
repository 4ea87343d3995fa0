"""CSV text conventions, typed load and audit."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from shopscope.sources import csv_files

HEADER = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp"


def test_null_empty_quotes_and_newlines(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        HEADER
        + '\nr1,o1,5,"",,2018-01-18 00:00:00,2018-01-18 21:46:59'
        + '\nr2,o2,,"say ""hi""","two\nlines, one comma",2018-01-18,\n'
        + "r3,o3,1, padded ,\\N,,\n"
    )
    found = csv_files.read_csv(spark, "reviews", str(path)).orderBy("review_id").collect()
    assert (found[0]["review_comment_title"], found[0]["review_comment_message"]) == ("", None)
    assert found[0]["review_creation_date"] == date(2018, 1, 18)
    assert found[0]["review_answer_timestamp"] == datetime(2018, 1, 18, 21, 46, 59)
    assert found[1]["review_score"] is None
    assert found[1]["review_comment_title"] == 'say "hi"'
    assert found[1]["review_comment_message"] == "two\nlines, one comma"
    assert (found[2]["review_comment_title"], found[2]["review_comment_message"]) == (" padded ", "\\N")


def test_load_replaces_and_audits(spark, tmp_path):
    payments = tmp_path / "payments.csv"
    payments.write_text("a,b,c,d,e\no1,1,boleto,1,10.50\no2,1,voucher,0,0.00\n")
    target = str(tmp_path / "bronze")
    for _ in range(2):
        loaded = csv_files.load(spark, {"payments": str(payments)}, target)
    assert loaded["payments"].count() == 2
    assert loaded["payments"].orderBy("order_id").first()["payment_value"] == Decimal("10.50")
    log = csv_files.load_audit(spark, target).collect()
    assert [(r["table_name"], r["row_count"], r["status"]) for r in log] == [("payments", 2, "SUCCESS")]


def test_unclosed_quote_fails_by_name(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    rows = "".join(f'r{i},o{i},5,"title","text",,\n' for i in range(5000))
    path.write_text(f'{HEADER}\nr,o,5,"never closed,,,\n{rows}')
    with pytest.raises(Exception, match="never closed in .*reviews.csv"):
        csv_files.read_csv(spark, "reviews", str(path)).count()


def test_fixed_width_text_ignores_trailing_blanks(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("a,b,c,d\ns1,123  ,Town ,SP \n")
    row = csv_files.read_csv(spark, "sellers", str(path)).first()
    assert (row["seller_zip_code_prefix"], row["seller_city"], row["seller_state"]) == ("123", "Town ", "SP")


def test_one_failing_load_leaves_the_others_in_the_log(spark, tmp_path):
    (tmp_path / "payments.csv").write_text("a,b,c,d,e\no1,1,boleto,1,10.50\n")
    (tmp_path / "sellers.csv").write_text("a,b,c,d\ns1,1,x,SP,too,many\n")
    target = str(tmp_path / "bronze")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_files.load(spark, {t: str(tmp_path / f"{t}.csv") for t in ("sellers", "payments")}, target)
    assert [row["table_name"] for row in csv_files.load_audit(spark, target).collect()] == ["payments"]


def test_bad_row_fails_and_is_not_audited(spark, tmp_path):
    payments = tmp_path / "payments.csv"
    payments.write_text("a,b,c,d,e\no1,one,boleto,1,10.50\n")
    target = str(tmp_path / "bronze")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_files.load(spark, {"payments": str(payments)}, target)
    assert csv_files.load_audit(spark, target).count() == 0


def test_round_trip_keeps_text(spark, tmp_path):
    from tests.fixtures import raw_table

    texts = ["", None, " x ", 'a "quoted" word', "line\nbreak", "comma, here", "back\\slash"]
    rows = [{"review_id": str(i), "review_comment_message": text} for i, text in enumerate(texts)]
    path = str(tmp_path / "out")
    csv_files.write_csv(raw_table(spark, "reviews", rows), path)
    found = csv_files.read_csv(spark, "reviews", path).collect()
    assert {row["review_id"]: row["review_comment_message"] for row in found} == {str(i): t for i, t in enumerate(texts)}


@pytest.mark.parametrize("split_bytes", ["64", "1000", "100000"])
def test_multi_line_records_across_splits(spark, tmp_path, split_bytes):
    import random

    rng = random.Random(5)
    pieces = ["plain", "two\nlines", 'say ""x""', "", "a,b", "\n\n", 'end""\n', "long " * 30, "\r\nx"]
    expected = {}
    for number in range(3):
        body = HEADER + "\n"
        for i in range(200):
            text = "".join(rng.choice(pieces) for _ in range(rng.randrange(4)))
            expected[f"r{number}-{i}"] = text.replace('""', '"')
            body += f'r{number}-{i},o,3,,"{text}",,\n'
        (tmp_path / f"part{number}.csv").write_text(body, newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = csv_files.read_csv(spark, "reviews", str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == len(expected)
    assert {row["review_id"]: row["review_comment_message"] for row in rows} == expected
