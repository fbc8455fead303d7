"""Stage tables: built once, named by their marker, keyed on code and input."""

from sparkfolio.plans import stages as S

SF = "/root/testdata/sf0.001"


def test_built_once_and_read_back(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    for _ in range(3):
        assert S.stage(spark, SF, "once", ["region"], build).count() == 5
    assert len(calls) == 1


def test_unfinished_write_is_not_read(spark, tmp_path):
    base = str(tmp_path / "t")

    def fails(path):
        spark.range(3).write.parquet(path)
        raise OSError("lost")

    try:
        S._once(spark, base, fails)
    except OSError:
        pass
    path = S._once(spark, base, lambda p: spark.range(4).write.parquet(p))
    assert spark.read.parquet(path).count() == 4 and len(list(tmp_path.glob("t-*"))) == 2


def test_two_builders_agree(spark, tmp_path):
    """A second driver that publishes while the first builds: both read one folder, and no file is touched."""
    base = str(tmp_path / "t")
    seen = []

    def other(path):
        spark.range(7).write.parquet(path)

    def first(path):
        seen.append(S._once(spark, base, other))
        spark.range(7).write.parquet(path)

    path = S._once(spark, base, first)
    assert path == S._once(spark, base, other) and spark.read.parquet(path).count() == 7 == spark.read.parquet(seen[0]).count()


def test_key_follows_code_and_input(spark, monkeypatch):
    a = S.input_key(spark, SF, ["region"])
    assert a == S.input_key(spark, SF, ["region"]) != S.input_key(spark, SF, ["nation"])
    monkeypatch.setattr(S, "_CODE_KEY", "other")
    assert S.input_key(spark, SF, ["region"]) != a
