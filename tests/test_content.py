import os
import random

from ingot.operators.content import combined, fingerprints, validate_content
from tests.conftest import write_gz


def test_fingerprints_are_of_multisets_and_add_up(spark):
    rnd = random.Random(1)
    lines = [(f"f{k % 5}", f"line {rnd.randrange(300)}") for k in range(2000)] + [("f0", " "), ("f1", None)]
    df = spark.createDataFrame(lines, "rel_path string, value string")
    a = {r.rel_path: r for r in fingerprints(df).collect()}
    rnd.shuffle(lines)
    assert a == {r.rel_path: r for r in fingerprints(spark.createDataFrame(lines, df.schema).repartition(7)).collect()}
    whole = fingerprints(df.selectExpr("'all' g", "value"), "g").first()
    assert combined(fingerprints(df)).first()[:] == whole[1:] and 0 <= int(whole.f1) < 1 << 64 and len({r.f1 for r in a.values()}) == 5
    x, y = ([(1, f"{p}")] * 2 + [(1, "z")] for p in "ab")  # a line twice is not another twice
    assert fingerprints(spark.createDataFrame(x, "g int, value string"), "g").first() != fingerprints(spark.createDataFrame(y, "g int, value string"), "g").first()


def test_replaced_lines_are_found(spark, tmp_path):
    root = tmp_path / "data" / "works"
    for name, lines in (("a", "123"), ("b", "456"), ("c", "789"), ("d", "x"), ("e", "")):
        write_gz(str(root / "f" / f"{name}.gz"), list(lines))
    args = (spark, "works", "v1", str(tmp_path / "data"), str(tmp_path / "ledger"))
    got = lambda run: {(r.file[2], r.status, r.old_records, r.new_records, r.was) for r in validate_content(*args, batch_id=run).collect()}
    assert got(0) == {(n, "ADDED", None, k, None) for n, k in zip("abcde", (3, 3, 3, 1, 0))}
    write_gz(str(root / "f" / "a.gz"), list("321"))  # another order
    write_gz(str(root / "f" / "b.gz"), list("457"))  # as many lines, one replaced
    write_gz(str(root / "f" / "c.gz"), list("7899"))
    os.rename(root / "f" / "d.gz", root / "f" / "g.gz")
    want = {("a", "SAME", 3, 3, None), ("b", "CONTENT", 3, 3, None), ("c", "COUNT", 3, 4, None), ("d", "REMOVED", 1, None, None), ("e", "SAME", 0, 0, None), ("g", "ADDED", None, 1, "f/d.gz")}
    assert got(1) == want
    assert got(2) == {(n, "SAME", k, k, None) for n, k in zip("abceg", (3, 3, 4, 0, 1))}
