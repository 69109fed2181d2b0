"""Range reader against Spark's multiLine reader and a plain split, and the reject channel's sums."""

import csv
import io
import os
import random

import pytest

from marketscope.sources import registry, splitcsv
from marketscope.sources import schemas as S

BITS = ["a", "Ç", ";", ",", "\n", '"', " ", "NA", "\r\n", ""]


def write(path, name, data):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "wb") as fh:
        fh.write(data)


def quoted(rows, sep, end="\n"):
    out = io.StringIO()
    csv.writer(out, delimiter=sep, quoting=csv.QUOTE_ALL, lineterminator=end).writerows(rows)
    return out.getvalue()


def random_rows(rng, fields, count):
    return [["".join(rng.choices(BITS, k=rng.randint(0, 6))) for _ in range(fields)] for _ in range(count)]


@pytest.mark.parametrize("end,last", [("\n", True), ("\r\n", True), ("\n", False)])
def test_range_records_are_whole_whatever_the_ranges(end, last):
    rng = random.Random(1)
    for _ in range(30):
        rows = random_rows(rng, 3, rng.randint(1, 12))
        text = quoted(rows, ";", end).encode("latin-1")
        if not last:
            text = text[:-len(end)]
        lines, at = [], 0
        for r in rows:
            one = quoted([r], ";", "").encode("latin-1")
            lines.append((at, 3, one))
            at += len(one) + len(end)
        for size, block in [(1, 1), (3, 2), (7, 100), (50, 9), (1000, 5)]:
            got, quotes = [], 0
            for start in range(0, len(text), size):
                part = splitcsv.range_records(io.BytesIO(text), start, min(start + size, len(text)), quotes % 2 == 1, ";", block)
                for places, counts, texts in part:
                    got += list(zip(places.tolist(), counts.tolist(), texts.to_pylist()))
                quotes += text[start:start + size].count(b'"')
            assert got == lines, (size, block)


def test_equals_the_multiline_reader(spark, tmp):
    rng = random.Random(2)
    n = len(S.EMPRESAS_COLUMNS)
    for k in range(3):
        write(tmp, f"F{k}.EMPRECSV", quoted(random_rows(rng, n, 200), ";").encode("latin-1"))
    write(tmp, "F9.EMPRECSV", b"")
    write(tmp, "other.csv", b"ignored\n")
    want = registry.read_registry_csv(spark, tmp, "empresas").collect()
    for size in (97, 1 << 20):
        got = splitcsv.read_registry_split(spark, tmp, "empresas", range_bytes=size)
        # the multiLine reader turns a quoted \r\n into \n; here fields keep their bytes
        rows = [tuple(v.replace("\r\n", "\n") for v in r) for r in got.collect()]
        assert sorted(rows) == sorted(map(tuple, want)) and len(want) == 600
    many = splitcsv.byte_ranges(spark, tmp, "*.EMPRECSV", 1000)
    assert many.count() > 10 and splitcsv._spread(many).rdd.getNumPartitions() == many.count()


def test_unquoted_and_short_lines_like_the_multiline_reader(spark, tmp):
    write(tmp, "A.EMPRECSV", b'1;x;"";;5;6;7\n\n2;only two\n3;"a;b";c;d;e;f;g;h\n4;;;;;;\n')
    want = sorted(map(tuple, registry.read_registry_csv(spark, tmp, "empresas").collect()))
    assert sorted(map(tuple, splitcsv.read_registry_split(spark, tmp, "empresas", 5).collect())) == want


def test_rejects_add_up(spark, tmp):
    good = ['1,f,c,001,"Ana\nMaria",10.5', '2,f,c,002,"x, y",NA', '3,f,c,003,z,']
    bad = ["4,f,c,004,short", "5,f,c,005,z,1,2", "6,f,c,006,z,12abc", '7,f,c,007,z,"1,5"', "lonely"]
    lines = [x for pair in zip(good, bad) for x in pair] + bad[3:]
    head = ",".join(S.VENDAS_SCHEMA.names)
    write(tmp + "/in", "v1.csv", ("\n".join([head, *lines]) + "\n").encode())
    write(tmp + "/in", "v2.csv", ("\r\n".join([head, good[0].replace("\n", " "), "", bad[0]])).encode())
    got = splitcsv.load_sales_csv(spark, tmp + "/in", tmp + "/out", range_bytes=16)
    assert sorted((r["it-codigo"], r.cliente, r.valor if r.valor is None else float(r.valor)) for r in got.accepted.collect()) == [
        ("1", "Ana\nMaria", 10.5), ("1", "Ana Maria", 10.5), ("2", "x, y", None), ("3", "z", None)]
    rejected = {(r.arquivo, r.registro): (r.motivo, r.campos) for r in got.rejected.collect()}
    assert rejected == {("v1.csv", bad[0]): (splitcsv.MISSING_FIELDS, 5), ("v1.csv", bad[1]): (splitcsv.EXTRA_FIELDS, 7),
                        ("v1.csv", bad[2]): (splitcsv.BAD_VALUE, 6), ("v1.csv", bad[3]): (splitcsv.BAD_VALUE, 6),
                        ("v1.csv", bad[4]): (splitcsv.MISSING_FIELDS, 1), ("v2.csv", bad[0]): (splitcsv.MISSING_FIELDS, 5)}
    counts = {(r.arquivo, r.motivo): r.linhas for r in got.counts().collect()}
    assert counts["v1.csv", None] == 3 and counts["v2.csv", None] == 1 and sum(counts.values()) == len(lines) + 2


def test_positions_point_at_the_records(spark, tmp):
    data = quoted(random_rows(random.Random(4), 7, 40), ";").encode("latin-1") + b"tail;without;end"
    write(tmp + "/in", "P.EMPRECSV", data)
    rows = splitcsv.records(spark, tmp + "/in", "*.EMPRECSV", range_bytes=64).collect()
    assert len(rows) == 41 and all(data[r.posicao:].startswith(r.registro.encode("latin-1")) for r in rows)
    got = splitcsv.load_registry_csv(spark, tmp + "/in", "empresas", tmp + "/out", 64)
    assert got.accepted.count() == 40 and [r.motivo for r in got.rejected.collect()] == [splitcsv.MISSING_FIELDS]
