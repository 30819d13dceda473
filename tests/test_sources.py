from pyspark.sql import functions as F

from sifter.operators import labels
from sifter.sources import files as FI
from sifter.sources import landing, tables

HEADER = ",".join(FI.CORPUS_COLUMNS)


def _row(i, id_, type_, content):
    cells = [""] * 17
    cells[0], cells[1], cells[2], cells[3], cells[5] = str(i), id_, "site.com", type_, content
    return ",".join(cells)


def test_corpus_csv(spark, tmp_path):
    lines = [HEADER,
             _row(0, "1", "fake", '"a ""b""\nc"'),
             _row(1, "abc", "fake", "bad id"),
             _row(2, "3", "opinion", "unknown label"),
             _row(3, "4", "satire", "excluded"),
             "5,6,7",
             _row(5, "8", "reliable", "ok")]
    p = tmp_path / "corpus.csv"
    p.write_text("\n".join(lines) + "\n", encoding="utf-8")
    rows, rejects = FI.read_corpus_csv(spark, str(p))
    got = {r.id: r for r in rows.collect()}
    assert got[1].content == 'a "b"\nc'
    assert 8 in got and got[8].orig_type == "reliable"
    # the bad id and the short row are rejected, not fatal
    assert rejects.count() >= 1
    assert all(r.id is None or r._corrupt_record is not None for r in rejects.collect())
    kept, rej = labels.reduce_corpus(rows)
    assert sorted(r.id for r in kept.collect()) == [1, 8]
    assert {r.status for r in rej.collect()} >= {"skipped", "excluded"}


def test_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "fake", 'x "q"\ny'), (2, "reliable", "")],
                               "id long, type string, content string")
    FI.write_corpus_csv(df, str(tmp_path / "out"))
    rows, _ = FI.read_corpus_csv(spark, str(tmp_path / "out"))
    got = {r.id: r.content for r in rows.collect()}
    assert got[1] == 'x "q"\ny'


def test_statements_tsv_keeps_first_record(spark, tmp_path):
    recs = ["1.json\tfalse\tThe sky is green.\ts\tsp\tj\tst\tp\t0\t0\t0\t0\t0\tc",
            "2.json\thalf-true\tTaxes rose.\ts\tsp\tj\tst\tp\t0\t0\t0\t0\t0\tc",
            "3.json\ttrue\tWater is wet.\ts\tsp\tj\tst\tp\t0\t0\t0\t0\t0\tc"]
    p = tmp_path / "s.tsv"
    p.write_text("\n".join(recs) + "\n", encoding="utf-8")
    df = FI.read_statements_tsv(spark, str(p))
    assert df.count() == 3
    kept = {r.content: r.type for r in labels.statement_labels(df).collect()}
    assert kept == {"The sky is green.": "fake", "Water is wet.": "reliable"}
    assert df.select("id").distinct().count() == 3


def test_literal_map(spark):
    df = spark.createDataFrame([("{'a': 1, 'bc': 22}",), ("{}",)], "t string")
    got = [r.m for r in df.select(FI.parse_literal_map("t").alias("m")).collect()]
    assert got == [{"a": 1, "bc": 22}, {}]
    back = df.select(FI.format_literal_map(FI.parse_literal_map("t")).alias("x")).collect()
    assert back[0].x == "{'a': 1, 'bc': 22}"


def test_predictions_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "preds")
    a = spark.createDataFrame([(1, "svm", 0.5), (1, "linear", 0.1)], "id long, model string, score double")
    FI.write_predictions(a, path)
    b = spark.createDataFrame([(1, "svm", -0.5)], "id long, model string, score double")
    FI.write_predictions(b, path)
    got = {r.model: r.score for r in spark.read.parquet(path).collect()}
    assert got == {"svm": -0.5, "linear": 0.1}


def test_model_persistence(spark, tmp_path):
    from pyspark.sql import functions as F

    from sifter.operators import classifiers as CL
    from sifter.operators import persistence as P
    df = spark.createDataFrame([(i, "fake" if i % 2 else "reliable", {"a" if i % 2 else "b": 1})
                                for i in range(20)], "id long, type string, words map<string,int>")
    cv = CL.fit_vectorizer(df)
    model = CL.fit_model("multi_nb", CL.with_label(CL.vectorize(df, cv)))
    path = str(tmp_path / "m")
    P.save_vector_model(cv, model, path)
    P.save_metadata(spark, path, 2, {"alpha": 1.0})
    cv2, model2 = P.load_vector_model(path)
    a = CL.score(model, CL.vectorize(df, cv), "multi_nb").select("id", "score")
    b = CL.score(model2, CL.vectorize(df, cv2), "multi_nb").select("id", F.col("score").alias("s2"))
    assert a.join(b, "id").filter("abs(score - s2) > 1e-12").count() == 0
    meta = P.load_metadata(spark, path)
    assert meta["valset_used"] == 2 and meta["params"] == {"alpha": 1.0}


def test_row_cap(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9, 1)], "id long")
    assert [r.id for r in FI.row_cap(df, 2).collect()] == [1, 3]


def test_statement_ids_are_record_numbers(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = [(i * 3, "true" if i % 2 else "false", f"statement {i} " + "x" * (i % 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, orig_type string, content string").repartition(7)
    FI.write_statements_tsv(df.withColumn("content", df.content), str(tmp_path / "tsv"), files=3)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several blocks a file
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        read = FI.read_statements_tsv(spark, str(tmp_path / "tsv"))
        assert spark.read.text(str(tmp_path / "tsv")).rdd.getNumPartitions() > 5
        got = sorted(map(tuple, read.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [(n, t, c) for n, (_, t, c) in enumerate(rows)]


def test_tsv_of_odd_records(spark, tmp_path):
    p = tmp_path / "odd.tsv"
    p.write_text("1\ttrue\tfirst\n\n2\tfalse\n3\t\tno label\tmore\n")
    got = sorted(map(tuple, FI.read_statements_tsv(spark, str(p)).collect()))
    assert got == [(0, "true", "first"), (1, "false", None), (2, None, "no label")]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.tsv").write_text("")
    assert FI.read_statements_tsv(spark, str(tmp_path / "none")).collect() == []


def test_csv_landed_by_status(spark, tmp_path):
    head = ",".join(FI.CORPUS_COLUMNS)
    line = lambda i, t, text: f"0,{i},d,{t},u,\"{text}\"" + "," * 11
    p = tmp_path / "raw.csv"
    p.write_text("\n".join([head, line(1, "fake", 'a ""b""\nc'), line(2, "satire", "x"), line("no", "fake", "y"), "0,4",
                            line(5, "opinion", "z"), line(6, "reliable", "held"), line(7, "reliable", "w")]) + "\n")
    held = spark.createDataFrame([(6,), (2,)], "id long")
    landed, account = FI.land_corpus_csv(spark, str(p), str(tmp_path / "out"), held)
    assert account.first().asDict() == {"included": 2, "excluded": 1, "ignored": 1, "skipped": 3}
    assert {(r.id, r.content) for r in landed.filter("status = 'included'").collect()} == {(1, 'a "b"\nc'), (7, "w")}
    assert (tmp_path / "out" / "status=skipped").is_dir()


def test_landed_buckets_need_no_exchange(spark, tmp_path):
    from sifter.operators import features as FE
    from sifter.operators import vocab as V
    from sifter.sources import landing
    rows = [(i, "fake" if i % 2 else "reliable", f"word{i % 7} and word{i % 3}") for i in range(90)]
    df = spark.createDataFrame(rows, "id long, type string, content string")
    path = str(tmp_path / "landed")
    landed = landing.land_bucketed(df, path, buckets=8)
    again = landing.open_bucketed(spark, path, buckets=8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for table in (landed, again):
            assert sorted(map(tuple, table.select("id", "type", "content").collect())) == rows
            counts = V.word_counts(FE.terms(table, ("id", "type"), stem=False))
            plan = counts._jdf.queryExecution().executedPlan().toString()
            exchanges = [x for x in plan.splitlines() if "Exchange" in x]
            assert len(exchanges) == 1 and "word" in exchanges[0] and "content" not in exchanges[0]
            side = spark.range(50)
            joined = table.join(side, "id")._jdf.queryExecution().executedPlan().toString()
            assert sum("Exchange" in x for x in joined.splitlines()) == 1  # of the narrow side
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_texts_that_may_be_kept_move(spark):
    from sifter.operators import bitset
    from sifter.sources import landing
    docs = spark.range(5000).selectExpr("id", "concat('text ', id) AS content").unionByName(
        spark.createDataFrame([(None, "no id")], "id long, content string"))
    ids = spark.createDataFrame([(i, i % 3) for i in range(0, 5000, 50)] + [(99_999, 0)], "id long, split int")
    maybe = bitset.prefilter(docs, "id", ids)
    kept = {r.id for r in maybe.collect()}
    assert set(range(0, 5000, 50)) <= kept and len(kept) < 130
    got = landing.kept_texts(docs, ids).collect()
    assert sorted((r.id, r.content, r.split) for r in got) == [(i, f"text {i}", i % 3) for i in range(0, 5000, 50)]
    assert bitset.prefilter(docs, "id", ids.limit(0)).count() == 0
    assert bitset.bits_for(0) == bitset.LEAST_BITS and bitset.bits_for(10**9) == bitset.MOST_BITS
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    assert {r.word for r in bitset.prefilter(words.unionByName(words), "word", words.limit(1), n_bits=1 << 16).collect()} == {"a"}


def test_records_by_quote_parity(spark, tmp_path):
    import csv
    import io
    import random

    from sifter.sources import numbered
    rnd = random.Random(6)
    pieces = ["plain", 'say ""hi""', "two\nlines", "a,b", "", "\n\n", "x" * 300, "é日本", '""', "tail\r\nend"]
    expected = {}
    for name in ("a.csv", "b.csv", "empty.csv"):
        rows = []
        for i in range(0 if name == "empty.csv" else 300):
            text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 4))).replace('""', '"')
            rows.append([str(len(expected)), name, text])
            expected[len(expected)] = (name, text or None)
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as f:
            f.write("id,domain,content\n")
            csv.writer(f, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        records = numbered.quoted_records(spark, str(tmp_path)).filter("NOT first")
        got = [next(csv.reader(io.StringIO(r.record, newline=""))) for r in records.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(got) == 600
    assert {int(i): (d, t or None) for i, d, t in got} == {k: (n, t) for k, (n, t) in expected.items()}


def test_parallel_csv_equals_the_whole_file_reader(spark, tmp_path):
    head = ",".join(FI.CORPUS_COLUMNS)
    line = lambda i, t, text: f"0,{i},d,{t},u,\"{text}\"" + "," * 11
    p = tmp_path / "raw.csv"
    p.write_text("\n".join([head, line(1, "fake", 'a ""b""\nc\n\nd'), line(2, "satire", ""), line("no", "fake", "y"), "0,4",
                            "", line(5, "opinion", "z,z"), line(6, "reliable", "'")]) + "\n")
    for plain, parallel in zip(FI.read_corpus_csv(spark, str(p)), FI.read_corpus_csv(spark, str(p), parallel=True)):
        columns = [c for c in plain.columns if c != FI.CORRUPT]
        assert sorted(map(str, plain.select(columns).collect())) == sorted(map(str, parallel.select(columns).collect()))


def test_texts_are_dealt_to_more_tasks_than_their_bytes_ask_for(spark, tmp_path):
    """Adaptive execution merges small partitions of packed texts; their words are counted in one task's memory."""
    spark.range(400).selectExpr("id AS doc_id", "concat('word', id) AS text").write.parquet(f"{tmp_path}/documents.parquet")
    want = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = tables.read_documents(spark, str(tmp_path), "doc_id", "text")
    ids = spark.range(400).withColumn("split", F.lit(3))
    docs = tables.read_table(spark, str(tmp_path), "documents").selectExpr("doc_id AS id", "text AS content")
    for df in (dealt, landing.kept_texts(docs, ids)):
        assert df.count() == 400 and df.select(F.spark_partition_id()).distinct().count() >= min(want, 4)
    assert tables.text_partitions(docs) >= want


def test_text_partitions_follow_the_stored_bytes(spark, tmp_path, monkeypatch):
    spark.range(400).selectExpr("id AS doc_id", "concat('word', id) AS text").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = tables.read_table(spark, str(tmp_path), "documents").select(F.col("text").alias("content"))
    monkeypatch.setattr(tables, "TEXT_BYTES", 10)
    stored = sum(f.stat().st_size for f in (tmp_path / "documents.parquet").glob("*.parquet"))
    assert tables.text_partitions(docs) == -(-stored // 10) > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_statements_files_grow_with_the_texts(spark, tmp_path, monkeypatch):
    from sifter.plans import catalog
    spark.range(60).selectExpr("id AS doc_id", "concat('word ', id) AS text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(9).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(tables, "text_partitions", lambda df: 11)
    counts, write = [], FI.write_statements_tsv
    monkeypatch.setattr(FI, "write_statements_tsv", lambda df, path, files=4: (counts.append(files), write(df, path, files)))
    assert [r.id for r in catalog.REGISTRY["statements_tsv"].fn(spark, str(tmp_path)).orderBy("id").collect()] == list(range(60))
    assert counts == [11]


def test_dict_text_is_parsed_once(spark, tmp_path, capsys):
    from sifter.plans import catalog
    spark.createDataFrame([(1, "a b's a"), (2, ""), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = catalog.REGISTRY["literal_map_roundtrip"].fn(spark, str(tmp_path))
    assert sorted((r.id, r.word, r.n) for r in df.collect()) == [(1, "a", 2), (1, "bs", 1)]
    df.explain("extended")
    optimized = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert optimized.count("regexp_extract_all(") == 1
