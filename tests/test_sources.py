import pytest

from tableprofile.operators.profile import missing_table
from tableprofile.operators.quality import quality_report
from tableprofile.plans.report import report_metrics, write_report
from tableprofile.sources.csv import read_csv, require_rows

TEXT = """id,name,score,flag,day,blank,big,mixed
1,"a ""quoted"" one",1.5,True,2024-01-01,,3000000000,1
2,NA,inf,False,2024-01-02,,1,x
3,"with, comma",,true,,,2,2
4,null,-1e3,TRUE,2024-01-03,N/A,3,3
"""


def write(tmp_path, text, name="data.csv", encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_types_and_missing_tokens(spark, tmp_path):
    df = read_csv(spark, write(tmp_path, TEXT))
    assert dict(df.dtypes) == {
        "id": "int", "name": "string", "score": "double", "flag": "boolean", "day": "string", "blank": "string",
        "big": "bigint", "mixed": "string",
    }
    rows = df.orderBy("id").collect()
    assert [r["name"] for r in rows] == ['a "quoted" one', None, "with, comma", None]
    assert [r["score"] for r in rows] == [1.5, float("inf"), None, -1000.0]
    assert [r["flag"] for r in rows] == [True, False, True, True]
    missing = {r["column"]: r["missing_count"] for r in missing_table(df).collect()}
    assert missing["blank"] == 4 and missing["name"] == 2 and missing["day"] == 1


def test_options(spark, tmp_path):
    path = write(tmp_path, "имя;n\nПётр;1d\nМария;2\n", encoding="utf-16")
    df = read_csv(spark, path, sep=";", encoding="UTF-16")
    assert [tuple(r) for r in df.collect()] == [("Пётр", "1d"), ("Мария", "2")]
    latin = write(tmp_path, "a,b\nÄrger,1\n", "latin.csv", encoding="latin-1")
    assert read_csv(spark, latin, encoding="ISO-8859-1").first()["a"] == "Ärger"
    lines = write(tmp_path, 'a,b\n"two\nlines",1\n', "lines.csv")
    assert read_csv(spark, lines, multi_line=True).first()["a"] == "two\nlines"
    typed = read_csv(spark, write(tmp_path, "a,b\n1,x\nNA,y\n", "typed.csv"), schema="a bigint, b string")
    assert typed.dtypes == [("a", "bigint"), ("b", "string")] and typed.where("a is null").count() == 1


def test_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="cannot read CSV"):
        read_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match="differ"):
        read_csv(spark, write(tmp_path, "a,b\n1,2\n"), schema="a int, c int")
    header_only = read_csv(spark, write(tmp_path, "a,b\n", "header.csv"))
    with pytest.raises(ValueError, match="no rows"):
        require_rows(header_only)
    assert require_rows(read_csv(spark, write(tmp_path, "a\n1\n", "one.csv"))).count() == 1


def test_lines_of_the_wrong_length(spark, tmp_path):
    short = read_csv(spark, write(tmp_path, "a,b,c\n1,2,3\n4\n5,6\n", "short.csv"))
    assert [tuple(r) for r in short.orderBy("a").collect()] == [(1, 2, 3), (4, None, None), (5, 6, None)]
    assert short.count() == 3
    long = write(tmp_path, 'a,b\n1,"x,y"\n2,3,4\n', "long.csv")
    with pytest.raises(ValueError, match="more fields"):
        read_csv(spark, long)
    with pytest.raises(Exception, match="more fields"):
        read_csv(spark, long, schema="a int, b string").count()


def activity(spark, tmp_path):
    lines = ["user_id,city,minutes,churned"]
    for i in range(36):
        lines.append(f"{min(i, 34)},{'' if i in (3, 9) else 'c%d' % (i % 5)},{'' if i == 7 else 2.5},{i % 2 if i < 34 else 0}")
    return read_csv(spark, write(tmp_path, "\n".join(lines) + "\n"))


def test_report_of_a_csv(spark, tmp_path):
    report = quality_report(activity(spark, tmp_path)).first()
    assert (report["n_rows"], report["n_cols"]) == (36, 4)
    assert report["quality_score"] == 1.0 - 2 / 36 - 0.2 - 0.1


def test_report_facts(spark, tmp_path):
    facts = {(r["section"], r["metric"]): r["value"] for r in report_metrics(activity(spark, tmp_path), "activity.csv").collect()}
    assert facts["shape", "n_rows"] == "36"
    assert facts["parameters", "min_missing_share"] == "30.0%"
    assert facts["quality", "quality_score"] == "0.64"
    assert facts["quality", "max_missing_share"] == "5.56%"
    assert facts["quality", "has_constant_columns"] == "true"
    assert facts["sections", "top_categories"] == "true"
    assert facts["sections", "histograms"] == "3"


def test_report_files(spark, tmp_path):
    out = str(tmp_path / "report")
    write_report(activity(spark, tmp_path), out, source="activity.csv")
    summary = read_csv(spark, f"{out}/summary")
    assert summary.columns[:3] == ["name", "dtype", "non_null"] and summary.count() == 4
    assert read_csv(spark, f"{out}/missing").columns == ["column", "missing_count", "missing_share"]
    correlation = read_csv(spark, f"{out}/correlation")
    assert correlation.columns == ["column", "user_id", "minutes", "churned"]
    tops = spark.read.option("header", True).csv(f"{out}/top_categories")
    assert {r["column"] for r in tops.collect()} == {"city"} and tops.count() == 5
    assert read_csv(spark, f"{out}/report").count() == 18


def test_report_files_of_an_empty_table(spark, tmp_path, empty):
    out = tmp_path / "report"
    write_report(empty, str(out))
    assert sorted(p.name for p in out.iterdir()) == ["report", "summary"]


def test_file_order(spark, tmp_path):
    """First-seen values of many files, cut in many blocks, are those of a sequential read."""
    from tableprofile.operators.frequency import distinct_values
    from tableprofile.operators.grouping import head_rows
    from tableprofile.operators.profile import example_values

    folder = tmp_path / "parts"
    folder.mkdir()
    lines, n = [], 0
    for name, size in (("b.csv", 900), ("a.csv", 40), ("c.csv", 2500), ("d.csv", 0)):
        rows = [(f"word{(n + i) * 7919 % 611}", (n + i) * 31 % 97 - 50, f"{name} line {i} " + "x" * 60) for i in range(size)]
        n += size
        (folder / name).write_text("w,v,t\n" + "".join(f"{w},{v},{t}\n" for w, v, t in rows))
        lines.append((name, rows))
    want = [row for _, rows in sorted(lines) for row in rows]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        df = read_csv(spark, str(folder), schema="w string, v int, t string", file_order="place")
        assert df.rdd.getNumPartitions() > 10
        assert [tuple(r)[:3] for r in df.orderBy("place").collect()] == want
        first = {}
        for w, _, _ in want:
            first.setdefault(w, None)
        assert [r[0] for r in distinct_values(df, "w", order_by="place").collect()] == list(first)
        assert [tuple(r)[:3] for r in head_rows(df, "place", 3).collect()] == want[:3]
        found = example_values(df, 4, order_by="place").where("column <> 'place'").collect()
        for i, c in enumerate(("w", "v", "t")):
            seen = list(dict.fromkeys(str(row[i]) for row in want))[:4]
            assert [r["value"] for r in sorted(found, key=lambda r: r["rank"]) if r["column"] == c] == seen
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    with pytest.raises(ValueError, match="have a column"):
        read_csv(spark, str(folder), file_order="v")
