import os

import pytest
from pyspark.errors import AnalysisException

from tablestats import clean_table, read_or_convert, read_table, write_table
from tablestats.sources import io
from tablestats.sources.io import read_lines, split_rejects, write_answers, write_report

CSV = (
    'name,release_date,price,user_score,metacritic_score,positive,negative,pct_pos_total,'
    'categories,genres,tags\n'
    '"Game, one",2014-12-31,$9.99,85,77,10,5,66.7,"[\'a\']",x,y\n'
    '"Say ""hi""",2015-01-01,Free,0,tbd,0,0,0.0,c,g,t\n'
    '"Two\nlines",Coming soon,"1,299.50",12.5%,0,3,1,,c,g,t\n'
)


def write_csv(folder, name="games"):
    path = os.path.join(folder, f"{name}.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(CSV)
    return path


def test_csv_quotes_and_line_breaks(spark, tmp_out):
    df = read_table(spark, write_csv(tmp_out))
    rows = df.collect()
    assert [r.name for r in rows] == ["Game, one", 'Say "hi"', "Two\nlines"]
    clean = clean_table(df).collect()
    assert [r.price for r in clean] == [9.99, None, 1299.5]
    assert [r.release_year for r in clean] == [2014, 2015, None]


def test_csv_text_or_inferred(spark, tmp_out):
    path = write_csv(tmp_out)
    text = dict(read_table(spark, path).dtypes)
    assert set(text.values()) == {"string"}
    inferred = dict(read_table(spark, path, infer=True).dtypes)
    assert inferred["positive"] == "int" and inferred["price"] == "string"
    a = clean_table(read_table(spark, path)).collect()
    b = clean_table(read_table(spark, path, infer=True)).collect()
    assert a == b


def test_read_or_convert_creates_and_reuses(spark, tmp_out):
    write_csv(tmp_out)
    first = read_or_convert(spark, tmp_out, "games")
    assert os.path.isdir(os.path.join(tmp_out, "games.parquet")) and first.count() == 3
    os.remove(os.path.join(tmp_out, "games.csv"))
    again = read_or_convert(spark, tmp_out, "games")  # the Parquet copy wins, CSV not needed
    assert again.count() == 3
    with pytest.raises(AnalysisException):
        read_or_convert(spark, tmp_out, "games", refresh=True)  # no CSV: error surfaces


def test_write_table_round_trips(spark, tmp_out):
    clean = clean_table(read_table(spark, write_csv(tmp_out)))
    pq = os.path.join(tmp_out, "clean.parquet")
    write_table(clean, pq)
    assert read_table(spark, pq).count() == 3 and read_table(spark, pq).columns == clean.columns
    csv_dir = os.path.join(tmp_out, "clean_csv")
    write_table(clean, csv_dir, fmt="csv", single=True)
    assert len([p for p in os.listdir(csv_dir) if p.startswith("part-")]) == 1
    back = read_table(spark, csv_dir, fmt="csv")
    assert sorted(r.name or "" for r in back.collect()) == sorted(r.name or "" for r in clean.collect())


def games(spark, folder):
    return sorted(r.name or "" for r in read_or_convert(spark, folder, "games").collect())


def test_changed_source_is_converted_again(spark, tmp_out):
    path = write_csv(tmp_out)
    assert len(games(spark, tmp_out)) == 3
    with open(path, "a", encoding="utf-8") as fh:
        fh.write("Fourth,2016-01-01,1,1,1,1,1,1,c,g,t\n")
    assert len(games(spark, tmp_out)) == 4
    stamp = os.stat(path)
    os.utime(path, (stamp.st_atime, stamp.st_mtime + 10))
    assert len(games(spark, tmp_out)) == 4
    os.remove(path)
    assert len(games(spark, tmp_out)) == 4  # without a source the copy is all there is
    assert [n for n in os.listdir(tmp_out) if n.startswith(".games")] == []


def test_copy_made_elsewhere_is_taken_as_it_is(spark, tmp_out):
    write_csv(tmp_out)
    spark.range(5).write.parquet(os.path.join(tmp_out, "games.parquet"))
    assert read_or_convert(spark, tmp_out, "games").count() == 5
    assert read_or_convert(spark, tmp_out, "games", refresh=True).count() == 3


def test_interrupted_refresh_keeps_a_copy(spark, tmp_out, monkeypatch):
    write_csv(tmp_out)
    before = games(spark, tmp_out)
    whole = io._rename

    def broken(at):
        calls = []

        def rename(s, old, new):
            calls.append(new)
            if len(calls) == at:
                raise OSError("cut off")
            whole(s, old, new)
        return rename

    for at in (1, 2):  # before the old copy went aside; before the new one took its place
        monkeypatch.setattr(io, "_rename", broken(at))
        with pytest.raises(OSError):
            read_or_convert(spark, tmp_out, "games", refresh=True)
        monkeypatch.setattr(io, "_rename", whole)
        if at == 2:
            assert not os.path.exists(os.path.join(tmp_out, "games.parquet"))
        os.rename(os.path.join(tmp_out, "games.csv"), os.path.join(tmp_out, "aside.csv"))
        assert games(spark, tmp_out) == before  # the copy is found without its source
        os.rename(os.path.join(tmp_out, "aside.csv"), os.path.join(tmp_out, "games.csv"))
    monkeypatch.setattr(io, "_publish", lambda *a: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        read_or_convert(spark, tmp_out, "games", refresh=True)
    monkeypatch.undo()
    assert games(spark, tmp_out) == before


RAGGED = 'k,n,v\n1,"a,b",2\n2,short\n3,x,y,long\n5,"say ""hi""",6\n6,z,7\n4,"unclosed,5\n'


@pytest.mark.parametrize("multi_line", [True, False])
def test_malformed_rows_are_kept_aside(spark, tmp_out, multi_line):
    with open(os.path.join(tmp_out, "ragged.csv"), "w", encoding="utf-8") as fh:
        fh.write(RAGGED)
    good = read_or_convert(spark, tmp_out, "ragged", multi_line=multi_line, rejects=True)
    assert sorted(tuple(r) for r in good.collect()) == [("1", "a,b", "2"), ("5", 'say "hi"', "6"), ("6", "z", "7")]
    bad = spark.read.parquet(os.path.join(tmp_out, "ragged.rejects.parquet"))
    assert bad.columns == ["record", "file", "k", "n", "v"] and bad.count() == 3
    assert sorted(r.record.strip()[:2] for r in bad.collect()) == ["2,", "3,", "4,"]
    assert all(r.file.endswith("ragged.csv") for r in bad.collect())
    assert read_or_convert(spark, tmp_out, "ragged").count() == 3


def test_values_that_do_not_fit_the_schema(spark, tmp_out):
    with open(os.path.join(tmp_out, "t.csv"), "w", encoding="utf-8") as fh:
        fh.write("k,_record\n1,a\nx,b\n")
    good, bad = split_rejects(spark, os.path.join(tmp_out, "t.csv"), os.path.join(tmp_out, "g"), os.path.join(tmp_out, "b"), "k int, _record string")
    assert [tuple(r) for r in good.collect()] == [(1, "a")]
    assert [(r.record, r._record) for r in bad.collect()] == [("x,b", "b")]


@pytest.mark.parametrize("parts", [1, 5])
def test_lines_come_back_in_order(spark, tmp_out, parts):
    lines = spark.range(400).selectExpr("cast(id div 50 as int) AS section", "cast(id as int) AS seq", "concat('l', id) AS line").repartition(7)
    path = os.path.join(tmp_out, "report")
    write_report(lines, path, parts=parts)
    files = [n for n in os.listdir(path) if n.startswith("part-")]
    assert len(files) == parts
    got = read_lines(spark, path).orderBy("part", "start", "row").collect()
    assert [r.line for r in got] == [f"l{i}" for i in range(400)]
    text = "".join(open(os.path.join(path, n), encoding="utf-8").read() for n in sorted(files))
    assert text == "".join(f"l{i}\n" for i in range(400))


def test_answers_leave_out_rows_without_one(spark, tmp_out):
    answers = spark.createDataFrame([(1, "yes"), (2, None), (3, "")], "i int, content string")
    write_answers(answers, os.path.join(tmp_out, "answers"))
    assert sorted(r.value for r in spark.read.text(os.path.join(tmp_out, "answers")).collect()) == ["", "yes"]
