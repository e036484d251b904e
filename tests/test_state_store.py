"""The state store after several nights equals a rebuild from all tokens."""

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

from offerloom.operators import state as S
from offerloom.plans import state_store as K

START = date(2024, 3, 1)
SCHEMA = "enterprise_id long, date date, date_time timestamp, token_name string, token int"


def tokens(rnd, entities, days, most=9):
    out = []
    for entity in entities:
        for day in days:
            for _ in range(rnd.randint(0, most)):
                at = datetime(2024, 3, 1) + timedelta(days=day, seconds=rnd.randrange(86_400))
                token = rnd.randrange(50)
                out.append((entity, START + timedelta(days=day), at, f"t{token}", token))
    return out


def same(spark, root, rows, max_len):
    want = S.flag_current(S.state_history(spark.createDataFrame(rows, SCHEMA), max_len))
    cols = ["enterprise_id", "date", "state", "state_tokenized", "size", "cum_size"]
    in_order = lambda df, names: sorted(map(tuple, df.select(*names).collect()))
    assert in_order(K.stored_history(spark, root), cols) == in_order(want, cols)
    cols.remove("size")
    assert in_order(K.current_states(spark, root), cols) == in_order(want.filter("current_record = 1"), cols)


@pytest.mark.parametrize("max_len", [5, 40])
def test_nights_equal_a_rebuild(spark, tmp_path, max_len):
    rnd, root = random.Random(max_len), str(tmp_path)
    nights = [
        tokens(rnd, range(12), range(4)),
        tokens(rnd, range(6, 16), [4]),  # only new days; some entities are new, some have nothing
        tokens(rnd, range(4, 20), [5, 6]) + tokens(rnd, range(3), [6]),
        tokens(rnd, range(0, 20, 3), [1, 4, 7]) + tokens(rnd, [30], [2]) + tokens(rnd, [1], [-3], 20),  # late days, stored and new ones
        tokens(rnd, range(20), [8]) + [(None, START, datetime(2024, 3, 1), "t1", 1)],
    ]
    every = []
    for night in nights:
        K.add_tokens(spark, spark.createDataFrame(night, SCHEMA), root, max_len)
        every += [t for t in night if t[0] is not None]
        same(spark, root, every, max_len)


def test_a_night_in_order_reads_no_old_day(spark, tmp_path):
    rnd, root = random.Random(1), str(tmp_path)
    first, second = tokens(rnd, range(10), range(3)), tokens(rnd, range(4, 14), [3])
    K.add_tokens(spark, spark.createDataFrame(first, SCHEMA), root, 10)
    kept = {}
    for file in [*Path(root).glob("state/date=*/*.parquet"), *Path(root).glob("state_days/date=*/*.parquet")]:
        kept[file] = file.read_bytes()
        file.write_bytes(b"whoever reads this fails")
    for sums in Path(root).glob("state*/date=*/.*.crc"):
        sums.unlink()
    K.add_tokens(spark, spark.createDataFrame(second, SCHEMA), root, 10)
    for file, data in kept.items():
        assert file.read_bytes() == b"whoever reads this fails"
        file.write_bytes(data)
    same(spark, root, first + second, 10)


def test_failed_night_is_repeated(spark, tmp_path, monkeypatch):
    rnd, root = random.Random(2), str(tmp_path)
    first, second = tokens(rnd, range(5), range(2)), tokens(rnd, range(5), [1, 2])
    K.add_tokens(spark, spark.createDataFrame(first, SCHEMA), root, 10)
    with monkeypatch.context() as m:
        m.setattr(K.Publication, "decide", lambda self: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            K.add_tokens(spark, spark.createDataFrame(second, SCHEMA), root, 10)
    same(spark, root, first, 10)
    K.add_tokens(spark, spark.createDataFrame(second, SCHEMA), root, 10)
    same(spark, root, first + second, 10)
