"""Records with line breaks from text in splits: both readings, long heads and tails, and what is shuffled."""

import csv
import io
import itertools
import random
import re

import pytest

from shopscope.sources.split_records import multi_line_records


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _texts():
    rng = random.Random(8)
    pieces = ["plain", "two\nlines", '""q""', "", "\n\n", "a,b", "x" * 90, "\n"]
    made = {}
    for name in ("a", "b"):
        fields = ["".join(rng.choice(pieces) for _ in range(rng.randrange(5))) for _ in range(120)]
        fields[40] = "long\n" * 400  # over several splits
        made[name] = 'id,"a header\nof two lines"\n' + "".join(f'{name}{i},"{text}"\n' for i, text in enumerate(fields))
    return made


def _expected(text):
    rows = list(csv.reader(io.StringIO(text, newline="")))[1:]
    return [tuple(row) for row in rows]


@pytest.mark.parametrize("kept, broadcast_splits", [(1 << 20, 10**6), (100, 10**6), (0, 0)])
def test_records_at_any_size_of_pieces(spark, tmp_path, workspace, small_splits, kept, broadcast_splits):
    texts = _texts()
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, newline="")
    (tmp_path / "empty.csv").write_text("")
    found = multi_line_records(spark, str(tmp_path), workspace, kept, broadcast_splits)
    rows = [tuple(next(csv.reader(io.StringIO(row["record"], newline="")))) for row in found.collect()]
    assert sorted(rows) == sorted(row for text in texts.values() for row in _expected(text))


def test_no_exchange_carries_lines(spark, tmp_path, workspace, small_splits):
    (tmp_path / "a.csv").write_text(_texts()["a"], newline="")
    found = multi_line_records(spark, str(tmp_path), workspace)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    assert sum("FileScan text" in line for line in plan) == 1  # once more when the splits were read
    depth = lambda line: re.search(r"[A-Za-z*]|$", line).start()
    exchanges = [n for n, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert exchanges
    for n in exchanges:
        below = list(itertools.takewhile(lambda line: depth(line) > depth(plan[n]), plan[n + 1 :]))
        assert not any("FileScan text" in line for line in below)


def test_a_quote_that_is_never_closed(spark, tmp_path, workspace, small_splits):
    (tmp_path / "good.csv").write_text('h\n"a\nb"\n')
    (tmp_path / "bad.csv").write_text("h\n" + '"fine"\n' * 100 + '"never closed\n' + '"x"\n' * 100)
    with pytest.raises(ValueError, match="never closed in .*bad.csv"):
        multi_line_records(spark, str(tmp_path), workspace)
