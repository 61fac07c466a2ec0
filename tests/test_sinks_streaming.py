"""Sinks (K1, K4, K7), batch inference (P2) and the incremental digest."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from mailsift.operators import render_item_list
from mailsift.operators.inference import infer
from mailsift.plans.digest import digest
from mailsift.plans.queries import _digest_params, digest_q
from mailsift.plans import standins as S
from mailsift.session import written
from mailsift.sinks import text_file_digests, write_items_jsonl, write_summaries, write_text_files
from mailsift.streaming.incremental import incremental_digest_from_table, start_incremental_digest
from tests.conftest import SF_SMALL


def read_json_lines(root):
    out = []
    for dirpath, _, files in os.walk(root):
        for f in sorted(files):
            if f.startswith("part-") and f.endswith(".json"):
                with open(os.path.join(dirpath, f), encoding="utf-8") as fh:
                    out.extend((os.path.basename(dirpath), json.loads(line)) for line in fh)
    return out


def test_jsonl_keeps_null_abstract_and_non_ascii(spark, tmp_out):
    df = spark.createDataFrame(
        [("2025-11-19", 1, "Café", "https://a/1", None), ("2025-11-19", 2, "B", "https://a/2", "x")],
        "report_date string, ordinal int, title string, link string, abstract string")
    path = os.path.join(tmp_out, "items")
    write_items_jsonl(df, path)
    rows = read_json_lines(path)
    objs = sorted((o for _, o in rows), key=lambda o: o["link"])
    assert objs[0] == {"title": "Café", "link": "https://a/1", "abstract": None}
    raw = open(next(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                    if f.endswith(".json") and os.path.getsize(os.path.join(d, f)) > 0),
               encoding="utf-8").read()
    assert '"abstract":null' in raw


def test_rerun_overwrites_only_its_day(spark, tmp_out):
    path = os.path.join(tmp_out, "summaries")
    mk = lambda day, text: spark.createDataFrame(
        [(day, "echo", text)], "report_date string, backend string, summary string")
    write_summaries(mk("2025-11-18", "old-18"), path)
    write_summaries(mk("2025-11-19", "first"), path)
    write_summaries(mk("2025-11-19", "second"), path)
    got = sorted((str(r.report_date), r.summary) for r in spark.read.parquet(path).collect())
    assert got == [("2025-11-18", "old-18"), ("2025-11-19", "second")]


def test_infer_backends_and_errors(spark):
    prompts = spark.createDataFrame([(1, "a\nb"), (2, "boom")], "k long, prompt string")

    def factory():
        def fn(p):
            if p == "boom":
                raise RuntimeError("model down")
            return f"  {p.upper()}  \n"
        return fn

    got = {r.k: (r.backend, r.summary, r.error)
           for r in infer(prompts, "stub", ["k"], backends={"stub": factory}).collect()}
    assert got[1] == ("stub", "A\nB", None)
    assert got[2][1] is None and "model down" in got[2][2]
    with pytest.raises(ValueError):
        infer(prompts, "nope", ["k"])


def test_written_cuts_lineage(spark):
    df = written(spark.range(5).withColumn("x", F.col("id") * 2))
    assert df.count() == 5


def test_stream_equals_batch(spark, tmp_out):
    batch = sorted(tuple(r) for r in digest_q(spark, SF_SMALL).collect())
    stream = incremental_digest_from_table(spark, SF_SMALL, _digest_params(),
                                           out_dir=os.path.join(tmp_out, "t1"))
    assert sorted(tuple(r) for r in stream.collect()) == batch


def test_stream_in_several_batches_equals_batch(spark, tmp_out):
    """Messages arrive in three files, newest first; the result still equals batch."""
    pages = spark.read.parquet(os.path.join(SF_SMALL, "pages.parquet"))
    land = os.path.join(tmp_out, "landing")
    ids = sorted(r.page_id for r in pages.select("page_id").collect())
    cuts = [ids[len(ids) * 2 // 3:], ids[len(ids) // 3: len(ids) * 2 // 3], ids[: len(ids) // 3]]
    for i, cut in enumerate(cuts):
        pages.filter(F.col("page_id").isin(cut)).coalesce(1).write.parquet(
            os.path.join(land, f"part{i}"))
    stream = (spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(land))
    out = os.path.join(tmp_out, "t1b")
    start_incremental_digest(S.page_messages(stream), out, _digest_params()).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "digest")).select(
        "report_date", "ordinal", "uid", "pos", "title", "link", "abstract").collect())
    assert got == sorted(tuple(r) for r in digest_q(spark, SF_SMALL).collect())


def test_run_digest_end_to_end(spark, tmp_out):
    from mailsift.plans.digest import digest_stages
    from mailsift.plans.run import run_digest

    pages = spark.read.parquet(os.path.join(SF_SMALL, "pages.parquet"))
    msgs = S.page_messages(pages)
    p = _digest_params(report_by=("sender",))
    paths = run_digest(msgs, p, os.path.join(tmp_out, "run"), S.GENERATED_AT)
    stages = digest_stages(msgs, p)
    saved_n = stages["saved"].count()
    selected = stages["selected"].groupBy("sender").count().collect()
    assert len(read_json_lines(paths["items"])) == saved_n
    lists = spark.read.text(paths["lists"], wholetext=True)
    assert lists.count() == stages["saved"].select("sender").distinct().count()
    assert all(r.value.startswith("# Alert items (saved)\n\n1. ") for r in lists.collect())
    prompts = spark.read.parquet(paths["prompts"])
    assert prompts.count() == len(selected)
    summ = spark.read.parquet(paths["summaries"]).collect()
    assert {r.backend for r in summ} == {"echo"} and all(r.summary for r in summ)
    reports = spark.read.parquet(paths["reports"]).collect()
    assert len(reports) == len(selected)
    totals = {r.sender: r["count"] for r in selected}
    for r in reports:
        assert f"<dt>Total items</dt><dd>{totals[r.sender]}</dd>" in r.text
    funnel = {(r.sender, r.stage): r.n for r in spark.read.parquet(paths["funnel"]).collect()}
    assert sum(n for (_, st), n in funnel.items() if st == "saved") == saved_n


def test_stream_of_eml_files_equals_batch(spark, tmp_out):
    """Raw .eml files arriving in two folders: headers, sender filter, body decode per batch."""
    from mailsift.plans.digest import DigestParams, digest
    from mailsift.sources import read_messages

    pages = spark.read.parquet(os.path.join(SF_SMALL, "pages.parquet"))
    raw = S.page_raw_messages(pages).collect()
    land = os.path.join(tmp_out, "eml")
    for i, r in enumerate(sorted(raw, key=lambda r: r.uid)):
        sub = os.path.join(land, f"b{i % 2}")
        os.makedirs(sub, exist_ok=True)
        with open(os.path.join(sub, f"{r.uid}.eml"), "wb") as fh:
            fh.write(bytes(r.raw))
    senders = [r.address for r in S.blog_senders(pages).collect()]
    p = DigestParams(senders=senders, contains=(), prefixes=S.PAGE_PREFIXES,
                     terms=list(S.PAGE_TERMS), extractor="native")

    def as_msgs(df):
        return df.withColumn("report_date", F.to_date(F.lit(S.RUN_DATE)))
    batch = sorted(tuple(r) for r in digest(as_msgs(read_messages(spark, land)), p).collect())
    assert batch
    files = (spark.readStream.format("binaryFile")
             .schema("path string, modificationTime timestamp, length long, content binary")
             .option("pathGlobFilter", "*.eml")
             .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 20).load(land))
    uid = F.regexp_extract(F.col("path"), r"(\d+)\.eml$", 1).cast("long")
    stream = as_msgs(files.select(uid.alias("uid"), F.col("content").alias("raw")))
    out = os.path.join(tmp_out, "t1eml")
    start_incremental_digest(stream, out, p).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "digest")).select(
        "report_date", "ordinal", "uid", "pos", "title", "link", "abstract").collect())
    assert got == batch


ANCHORS = "".join(f'<a href="/{i}">Item number {i}</a>' for i in range(5))


def _messages(spark, rows):
    return spark.createDataFrame(rows, "report_date string, uid long, html string")


def _params(**kw):
    from mailsift.plans.digest import DigestParams

    return DigestParams(contains=(), prefixes=("/",), terms=[], extractor="native", **kw)


def test_each_day_calls_the_model_for_itself_alone(spark, tmp_out):
    from mailsift.plans.run import run_digest

    calls = os.path.join(tmp_out, "calls")
    os.makedirs(calls)

    def factory(temperature, max_output_tokens):
        import uuid

        assert (temperature, max_output_tokens) == (0.1, 50)

        def fn(prompt):
            open(os.path.join(calls, uuid.uuid4().hex), "w").close()
            return "ok"
        return fn

    out, seen = os.path.join(tmp_out, "days"), {}
    for day in (1, 2, 3):
        run_digest(_messages(spark, [(f"2025-11-1{day}", day, ANCHORS)]), _params(), out,
                   f"2025-11-1{day} 08:00:00", backend="stub", backends={"stub": factory},
                   options={"temperature": 0.1, "max_output_tokens": 50})
        assert len(os.listdir(calls)) == day
        now = {r.report_date: r.text
               for r in spark.read.parquet(os.path.join(out, "reports")).collect()}
        assert len(now) == day and all(now[k] == v for k, v in seen.items())
        seen = now
    # a rerun that leaves nothing clears that day and no other
    run_digest(_messages(spark, [("2025-11-12", 2, "<p>no links today</p>")]), _params(), out,
               "2025-11-12 09:00:00", backend="stub", backends={"stub": factory},
               options={"temperature": 0.1, "max_output_tokens": 50})
    for kind in ("prompts", "reports", "summaries"):
        got = {r.report_date for r in spark.read.parquet(os.path.join(out, kind)).collect()}
        assert got == {"2025-11-11", "2025-11-13"}, kind
    assert {d for d, _ in read_json_lines(os.path.join(out, "items"))} == {
        "report=is-2025-11-11", "report=is-2025-11-13"}


def test_null_and_empty_report_keys_get_reports(spark, tmp_out):
    from mailsift.plans.run import run_digest

    rows = [(None, 1, ANCHORS), ("", 2, ANCHORS), ("a@x", 3, ANCHORS)]
    msgs = spark.createDataFrame(rows, "sender string, uid long, html string")
    paths = run_digest(msgs, _params(report_by=("sender",)), os.path.join(tmp_out, "keys"),
                       "2025-11-19 09:00:00")
    reports = spark.read.parquet(paths["reports"]).collect()
    assert sorted(str(r.sender) for r in reports) == ["", "None", "a@x"]
    assert all("<dd>3</dd>" in r.text for r in reports)
    assert len(read_json_lines(paths["items"])) == 9


@pytest.mark.parametrize("recent", [0, 2, 100])
def test_stream_equals_batch_with_latest_and_shrinking_reports(spark, tmp_out, recent):
    from mailsift.plans.digest import digest

    rows = [(f"r{u % 3}", u, f'<a href="/{u}">Item number {u}</a>'
             + "".join(f'<a href="/{u}/{i}">Item of {u} at {i}</a>' for i in range(u % 4)))
            for u in range(12)]
    p = _params(recent=recent)
    land = os.path.join(tmp_out, "land")
    for i in range(3):
        _messages(spark, rows[i::3]).coalesce(1).write.parquet(os.path.join(land, f"p{i}"))
    stream = (spark.readStream.schema("report_date string, uid long, html string")
              .option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(land))
    out = os.path.join(tmp_out, "t1r")
    start_incremental_digest(stream, out, p).awaitTermination()
    want = digest(_messages(spark, rows), p)
    got = spark.read.parquet(os.path.join(out, "digest")).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("size", [1, 7])
def test_a_list_file_is_written_and_digested_in_parts(spark, tmp_out, size):
    """One file a report, from many rows of a few items each; read back by many tasks."""
    rows = [(rep, i + 1, f"Title {i}\rof {rep}", f"https://a/{i}", "é x\n" * (i % 5) or None)
            for rep, n in (("big", 500), ("small", 1), (None, 30)) for i in range(n)]
    items = spark.createDataFrame(rows, "rep string, ordinal int, title string, link string, abstract string")
    path, whole = os.path.join(tmp_out, "lists"), render_item_list(items, ["rep"]).collect()
    parts = render_item_list(items, ["rep"], items_per_part=size)
    assert parts.count() == sum(-(-n // size) for n in (500, 1, 30))
    write_text_files(parts, path, "markdown", ["rep"], order=["chunk"])
    want = {}
    for r in whole:
        folder = os.path.join(path, "report=none" if r.rep is None else f"report=is-{r.rep}")
        [name] = [n for n in os.listdir(folder) if n.endswith(".txt")]
        with open(os.path.join(folder, name), "rb") as f:
            data = f.read()
        assert data == r.markdown.encode()
        want[os.path.basename(folder).removeprefix("report=")] = hashlib.md5(data).hexdigest()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = text_file_digests(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        assert {r.report: r.text_md5 for r in got.collect()} == want and got.count() == len(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lists_filed_holds_no_whole_list(spark, monkeypatch):
    """The query writes its lists from parts and reads no file as one value."""
    from mailsift.plans import queries

    seen, write = [], queries.write_text_files

    def counting(docs, *a, **k):
        seen.append(docs.agg(F.max("n_items"), F.sum("n_items"), F.countDistinct("lang")).first())
        write(docs, *a, **k)

    monkeypatch.setattr(queries, "write_text_files", counting)
    got = queries.QUERIES["lists_filed"](spark, SF_SMALL)
    assert seen[0][0] == 1 < seen[0][1] and got.count() == seen[0][2]


def _page_rows(n):
    return [(u, f"https://site{u % 3}.example/p", f'<a href="/{u}">Nation of number {u}</a>' + "".join(
        f'<a href="/{u % 4}/{i}">Item of the station {i}</a>' for i in range(u % 5))) for u in range(n)]


PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("recent", [0, 7])
def test_table_in_a_folder_of_files_is_streamed_whole(spark, tmp_out, recent):
    """A table is one file or a folder of files; both give the batch digest."""
    want = None
    for files in (1, 6):
        d = os.path.join(tmp_out, f"of{files}")
        path = os.path.join(d, "pages.parquet")
        spark.createDataFrame(_page_rows(40), PAGES).repartition(files).write.parquet(path)
        if files == 1:  # the file itself, as a table of that name
            part = next(n for n in os.listdir(path) if n.startswith("part-"))
            d = os.path.join(tmp_out, "file")
            os.makedirs(d)
            os.link(os.path.join(path, part), os.path.join(d, "pages.parquet"))
        out = os.path.join(tmp_out, f"out{files}")
        got = incremental_digest_from_table(spark, d, _digest_params(recent=recent), out)
        want = want or sorted(map(tuple, digest(S.page_messages(
            spark.read.parquet(path)), _digest_params(recent=recent)).select(*got.columns).collect()))
        assert sorted(map(tuple, got.collect())) == want and len(want) > 5
        commits = [n for n in os.listdir(os.path.join(out, "_progress", "commits")) if n.isdigit()]
        assert len(commits) == (1 if files == 1 else 3)  # bounded, whatever the number of files


def test_table_without_items_streams_to_an_empty_digest(spark, tmp_out):
    for name, rows in (("none", []), ("plain", [(1, "https://a.example/p", "<p>no links</p>")])):
        d = os.path.join(tmp_out, name)
        spark.createDataFrame(rows, PAGES).write.parquet(os.path.join(d, "pages.parquet"))
        got = incremental_digest_from_table(spark, d, _digest_params(), os.path.join(tmp_out, f"o-{name}"))
        assert got.schema["ordinal"].dataType.simpleString() == "int" and got.count() == 0


@pytest.mark.parametrize("recent", [0, 2])
def test_a_batch_reads_its_own_reports_alone(spark, tmp_out, recent, monkeypatch):
    """What a batch reads does not grow with the batches before it."""
    from mailsift.plans.digest import digest
    from mailsift.streaming import incremental

    read, folders, landed, newest = [], [], incremental._landed, incremental._newest

    def counting(spark, path, schema, touched, by):
        df = landed(spark, path, schema, touched, by)
        read.append(df.count())
        folders.append({f.split("report=")[1].split("/")[0] for f in df.inputFiles()})
        return df

    def keyed(seen, path, batch_id, p):
        out = newest(seen, path, batch_id, p)
        assert out[0].count() <= p.recent and len(incremental.sub_folders(spark, path)) <= 3
        return out

    monkeypatch.setattr(incremental, "_landed", counting)
    monkeypatch.setattr(incremental, "_newest", keyed)
    land, rows = os.path.join(tmp_out, "land"), []
    for day in range(8):
        own = [(f"2025-11-{10 + day}", 10 * day + i, "".join(
            f'<a href="/{day}/{i}/{k}">Item {k} of {i}</a>' for k in range(5))) for i in range(2)]
        rows += own
        _messages(spark, own).coalesce(1).write.parquet(os.path.join(land, f"p{day}"))
    stream = (spark.readStream.schema("report_date string, uid long, html string")
              .option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(land))
    out, p = os.path.join(tmp_out, "t1c"), _params(recent=recent)
    start_incremental_digest(stream, out, p).awaitTermination()
    assert len(read) == 8
    # its own report; with a limit also the one whose messages it pushes out
    assert max(read) <= (10 if not recent else 30)
    assert all(len(f) <= (1 if not recent else 3) for f in folders)
    want = digest(_messages(spark, rows), p)
    got = spark.read.parquet(os.path.join(out, "digest")).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_run_killed_before_its_commit_leaves_the_old_reports(spark, tmp_out, monkeypatch):
    from mailsift.sinks import writers

    path = os.path.join(tmp_out, "k7")
    first = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "rep string, v int")
    writers.write_reports(first, path, ["rep"])
    new = spark.createDataFrame([("a", 2), ("c", 2)], "rep string, v int")
    touched = spark.createDataFrame([("a",), ("b",), ("c",)], "rep string")

    def killed(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # killed when its rows are written, before the manifest
        m.setattr(writers, "_folder_names", killed)
        with pytest.raises(KeyboardInterrupt):
            writers.write_reports(new, path, ["rep"], touched)
    old = [(None, 1), ("a", 1), ("b", 1)]
    key = lambda r: (r[0] is not None, r)
    rows = lambda: sorted(((r.rep, r.v) for r in spark.read.parquet(path).collect()), key=key)
    assert rows() == old
    calls, recover = [], writers.recover

    def once(*a):
        calls.append(a)
        if len(calls) == 2:  # killed right after the manifest is in place
            raise KeyboardInterrupt
        recover(*a)

    with monkeypatch.context() as m:
        m.setattr(writers, "recover", once)
        with pytest.raises(KeyboardInterrupt):
            writers.write_reports(new, path, ["rep"], touched)
    assert rows() == old and any(n.startswith("manifest-") for n in os.listdir(os.path.join(path, "_runs")))
    writers.recover(spark, path)
    assert rows() == [(None, 1), ("a", 2), ("c", 2)]
    assert all(n.startswith("report=") for n in os.listdir(path) if n[0] not in "._")
    assert not [n for n in os.listdir(os.path.join(path, "_runs")) if n[0] != "."]
    writers.recover(spark, path)  # and again, to no effect
    assert rows() == [(None, 1), ("a", 2), ("c", 2)]


def test_run_counts_what_could_not_be_read(spark, tmp_out):
    from mailsift.plans.run import run_digest

    def mail(charset):
        return (f"From: a@x.org\r\nContent-Type: text/html; charset={charset}\r\n\r\n"
                + ANCHORS).encode()
    rows = [("d", 1, mail("utf-8")), ("d", 2, mail("x-none")), ("d", 3, mail("undefined"))]
    msgs = spark.createDataFrame(rows, "report_date string, uid long, raw binary")
    from mailsift.plans.digest import DigestParams

    p = DigestParams(contains=(), prefixes=("/",), terms=[])
    paths = run_digest(msgs, p, os.path.join(tmp_out, "sick"), "2025-11-19 09:00:00")
    health = {r.what: r.n for r in spark.read.json(paths["health"]).collect()}
    assert health == {"decoded": 3, "decode_errors": 2, "read": 1, "read_errors": 0}


def test_funnel_extracts_once(spark):
    """The funnel counts written stages: no extraction in its plan."""
    from mailsift.plans.queries import QUERIES

    text = QUERIES["stage_funnel"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "MapInArrow" not in text and "regexp_extract_all" not in text
