import random

import pytest
from pyspark.sql import functions as F

from sparkrank.operators.corpus import keep_last_sparse
from sparkrank.plans.experiments import make_run
from sparkrank.sources import readers, writers


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_collection_keeps_text_as_it_stands(spark, tmp_path):
    path = put(tmp_path / "c.tsv",
               '1\tNA\n2\t\n3\tsay "so", twice ""x""\n4\t"open\n5\tback\\slash\\\n6\t  blanks  \n'
               "7\tnull\n8\t#hash\n")
    assert pairs(readers.read_collection(spark, path)) == {
        ("1", "NA"), ("2", ""), ("3", 'say "so", twice ""x""'), ("4", '"open'),
        ("5", "back\\slash\\"), ("6", "  blanks  "), ("7", "null"), ("8", "#hash")}


def test_quoted_collection(spark, tmp_path):
    path = put(tmp_path / "c.tsv", '1\t"a ""b""\tc\nd"\n2\tplain\n')
    assert pairs(readers.read_collection(spark, path, quoted=True)) == {
        ("1", 'a "b"\tc\nd'), ("2", "plain")}


def quoted_rows(seed=4):
    r = random.Random(seed)
    bits = ["plain", '"', '""', "\n", "\t", " ", "\r", "é", "\n\n", 'in"side', "x" * 40, '"\n"', '\t"']
    return [(str(i), "".join(r.choices(bits, k=r.randint(0, 12)))) for i in range(300)]


@pytest.mark.parametrize("size", ["64b", "1k", "1m"])
def test_quoted_files_in_pieces(spark, tmp_path, size):
    rows = quoted_rows() + [("long", "a\n" * 500 + '"' + "\nb" * 300)]
    text = ""
    for i, t in rows:
        bare = t[:1] != '"' and not set("\n\t\r") & set(t) and int(i, 36) % 2
        text += i + "\t" + (t if bare else '"' + t.replace('"', '""') + '"') + "\n"
    path = str(tmp_path / "c.tsv")
    (tmp_path / "c.tsv").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = spark.read.text(path).rdd.getNumPartitions()
        assert read > 10 or size == "1m"
        found = pairs(readers.read_collection(spark, path, quoted=True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == set(rows)


def test_quoted_files_with_carriage_returns_and_open_quotes(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes(b'1\t"x"\r\n\r\n\n2\tsize 5"\n3\t"q"rest\n4\t"open\n5\tin\n')
    found = dict(pairs(readers.read_collection(spark, str(tmp_path / "a.tsv"), quoted=True)))
    assert (found["1"], found["2"], set(found)) == ("x", 'size 5"', {"1", "2", "3", "4"})
    assert found["4"].startswith('open\n5\tin') or found["4"].startswith('"open\n5\tin')
    (tmp_path / "empty.tsv").write_bytes(b"")
    assert pairs(readers.read_queries(spark, [str(tmp_path / "empty.tsv")], quoted=True)) == set()


def test_last_row_of_an_id_wins(spark, tmp_path):
    lines = "".join(f"{i % 50}\tt{i}\n" for i in range(120))
    path = put(tmp_path / "c.tsv", lines)
    expected = {(str(i % 50), f"t{i}") for i in range(70, 120)}
    assert pairs(readers.read_collection(spark, path)) == expected


def test_subset(spark, tmp_path):
    path = put(tmp_path / "c.tsv", "1\ta\n2\tb\n2\tc\n3\td\n")
    listed = put(tmp_path / "s.tsv", "2\n3\n3\n9\n")
    assert pairs(readers.read_collection(spark, path, listed)) == {("2", "c"), ("3", "d")}


def test_later_query_files_win(spark, tmp_path):
    one = put(tmp_path / "z.tsv", "1\ta\n2\tb\n")
    two = put(tmp_path / "a.tsv", "2\tc\n3\td\n")
    assert pairs(readers.read_queries(spark, [one, two])) == {("1", "a"), ("2", "c"), ("3", "d")}
    assert pairs(readers.read_queries(spark, [two, one])) == {("1", "a"), ("2", "b"), ("3", "d")}


def test_later_vector_files_win(spark, tmp_path):
    schema = "doc_id string, embedding array<float>"
    for name, rows in (("z", [("1", [1.0]), ("2", [2.0])]), ("a", [("2", [3.0])])):
        writers.write_vectors(spark.createDataFrame(rows, schema), str(tmp_path / name))
    found = readers.read_vectors(spark, [str(tmp_path / "z"), str(tmp_path / "a")], "doc_id")
    assert {(r[0], tuple(r[1])) for r in found.collect()} == {("1", (1.0,)), ("2", (3.0,))}


def test_keep_last_with_one_key_in_most_rows(spark):
    rows = [("hot", i, f"v{i}") for i in range(500)] + [(f"k{i}", 0, "x") for i in range(50)]
    df = spark.createDataFrame(rows, "id string, pos int, v string").repartition(4)
    found = pairs(keep_last_sparse(df, ["id"], ["pos"]))
    assert found == {("hot", "v499")} | {(f"k{i}", "x") for i in range(50)}


def test_qrels(spark, tmp_path):
    path = put(tmp_path / "q.tsv",
               "1 0 d1 1\n1\t0\td2\t2\n\n  2 0 d1 0 extra \n3 0 d1\n1 0 d1 3\n")
    assert pairs(readers.read_qrels(spark, path)) == {("1", "d1", 3), ("1", "d2", 2), ("2", "d1", 0)}
    assert pairs(readers.read_query_ids(spark, path)) == {("1",), ("2",), ("3",)}


def test_a_judgment_that_is_no_integer_is_an_error(spark, tmp_path):
    path = put(tmp_path / "q.tsv", "1 0 d1 yes\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_qrels(spark, path).collect()


@pytest.fixture
def run(spark):
    rows = [(f"q{q}", f"d{d}", 1.0 / d, d) for q in range(3) for d in range(1, 13)]
    ranked = spark.createDataFrame(rows, "query_id string, doc_id string, score double, rank int")
    asked = spark.createDataFrame([("a/b/qrels dev.tsv", f"q{q}") for q in range(3)],
                                  "qrels_name string, query_id string")
    return make_run(ranked, asked, "HNSW(8-200-50), C(m/x)", [1000, 100], [10, 3])


def test_run_names(run):
    assert {r[0] for r in run.select("run_name").distinct().collect()} == {
        "qrelsdev.tsv-HNSW(8-200-50),C(m-x)-[1000,100]-10.txt",
        "qrelsdev.tsv-HNSW(8-200-50),C(m-x)-[1000,100]-3.txt"}


def test_small_cutoff_is_a_prefix(run):
    keys = ["query_id", "doc_id", "rank", "score"]
    short = run.filter("cutoff = 3").select(keys)
    assert short.count() == 9
    assert short.exceptAll(run.filter("cutoff = 10 and rank <= 3").select(keys)).count() == 0


def test_run_files_round_trip(spark, run, tmp_path):
    path = str(tmp_path / "runs")
    writers.write_runs(run, path)
    back = readers.read_runs(spark, path)
    expected = run.select("run_name", "query_id", "doc_id", "rank",
                          F.round("score", 6).alias("score"), "run_id")
    assert pairs(back.select(expected.columns)) == pairs(expected)
    line = writers.run_lines(run).filter("query_id = 'q1' and rank = 3").first()["value"]
    assert line == "q1\t0\td3\t3\t0.333333\trun_1"


def test_one_ordered_file_per_run(spark, run, tmp_path):
    path = tmp_path / "runs"
    writers.write_runs(run.repartition(7), str(path))
    names = {r[0] for r in run.select("run_name").distinct().collect()}
    assert {f.name for f in path.iterdir() if not f.name.startswith(".")} == names
    for name in names:
        lines = [line.split("\t") for line in (path / name).read_text().splitlines()]
        assert [(f[0], int(f[3])) for f in lines] == sorted((f[0], int(f[3])) for f in lines)
        assert len(lines) == run.filter(F.col("run_name") == name).count()
    with pytest.raises(ValueError, match="exists"):
        writers.write_runs(run, str(path))
    with pytest.raises(ValueError, match="exists"):
        writers.write_runs(run, str(path), mode="append")
    writers.write_runs(run.filter("cutoff = 3"), str(path), mode="overwrite")
    assert [f.name for f in path.iterdir() if not f.name.startswith(".")] == [
        n for n in names if n.endswith("-3.txt")]


def test_long_runs_are_ordered_parts(spark, run, tmp_path):
    path = tmp_path / "runs"
    writers.write_runs(run, str(path), file_lines=10)
    long = next(f for f in path.iterdir() if f.is_dir() and f.name.endswith("-10.txt"))
    parts = sorted(f for f in long.iterdir() if not f.name.startswith("."))
    lines = [x.split("\t") for f in parts for x in f.read_text().splitlines()]
    assert len(parts) > 1 and len(lines) == 30
    assert [(f[0], int(f[3])) for f in lines] == sorted((f[0], int(f[3])) for f in lines)
    back = readers.read_runs(spark, str(path)).select("run_name", "query_id", "doc_id", "rank")
    assert pairs(back) == pairs(run.select(back.columns))


def test_no_run_is_an_empty_folder(spark, run, tmp_path):
    writers.write_runs(run.limit(0), str(tmp_path / "runs"))
    assert readers.read_runs(spark, str(tmp_path / "runs")).count() == 0


def test_flat_run_files(spark, tmp_path):
    put(tmp_path / "one.tsv-x-[1]-10.txt", "q\t0\td\t1\t0.500000\tr\nbroken line\n")
    assert pairs(readers.read_runs(spark, str(tmp_path))) == {
        ("one.tsv-x-[1]-10.txt", "q", "d", 1, 0.5, "r")}


def test_run_id_without_blanks(spark, run):
    with pytest.raises(ValueError, match="whitespace"):
        make_run(run, run, "x", [1], run_id="[1000, 100]")
