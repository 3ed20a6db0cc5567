"""Model callers, parser strategies, counters, content seen before, and the grid of boxes."""

import json
import logging
import random

import pytest
from pyspark.sql import functions as F

from docloom import tracing
from docloom.operators import equations
from docloom.operators.store import Store
from docloom.plans import pipeline
from docloom.sources import files, models, office, strategies
from docloom.sources.models import ModelError, Ring, Service
from docloom.streaming import ingest as incremental


def test_a_ring_hands_on_backs_off_and_breaks():
    calls = []

    def call(model, question):
        calls.append((model, question))
        script = {"one": [429, 429, "a"], "two": [429, "b", 500, 500]}[model]
        x = script[min(sum(m == model for m, _ in calls), len(script)) - 1]
        if isinstance(x, int):
            raise ModelError(x)
        return x

    ring = Ring(Service(call, ["one", "two"], wait=0.001))
    assert ring.ask("q1") == ("b", "two", 4, None)  # one, two, one again after a wait, two
    assert ring.ask("q2")[3] == "service: 500" and [m for m, _ in calls] == ["one", "two", "one", "two", "two", "two"]

    def spent(model, question):
        raise ModelError(429)

    ring = Ring(Service(spent, ["one", "two"], rounds=2, wait=0.001))
    assert ring.ask("q") == (None, "one", 4, "quota") and ring.ask("r")[2:] == (0, "quota")

    def closed(model, question):
        raise ModelError(403, "key expired")

    ring = Ring(Service(closed, ["one", "two"]))
    assert ring.ask("q")[2:] == (1, "refused: 403 key expired") and ring.ask("r")[2:] == (0, "refused: 403 key expired")


def test_questions_are_asked_once_and_answers_kept(spark, tmp_path):
    """Equal questions are one call; a run after a failure asks only what is open."""
    log = tmp_path / "calls"
    log.mkdir()

    def service(fails):
        def call(model, question):
            (log / f"{random.getrandbits(64)}").write_text(question)
            if fails and "7" in question:
                raise ModelError(500)
            return question.upper()

        return Service(call, ["m"], at_once=3)

    store = Store(spark, f"file://{tmp_path}/store")
    questions = spark.createDataFrame([(f"question {i % 20}",) for i in range(100)] + [(None,), (" ",)], "question string")
    got = models.ask(questions, service(True), store, wave=6).collect()
    assert len(got) == 20 and sorted(r["error"] or "" for r in got) == [""] * 18 + ["service: 500"] * 2
    first = [p.read_text() for p in log.iterdir()]
    assert len(first) == 22 and len(set(first)) == 20  # two tries each of those that failed
    got = models.ask(questions, service(False), store).collect()
    assert len(got) == 20 and not any(r["error"] for r in got)
    asked = [p.read_text() for p in log.iterdir()]
    assert sorted(asked[i] for i in range(len(asked))) == sorted([*first, "question 7", "question 17"])


def test_provider_of_a_model(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    chunks = spark.createDataFrame([("a", 1, "Creep = Slow growth of strain / 크리프 현상에 대한 긴 설명"), ("b", 1, "a text that the service answers wrongly"), ("c", 1, "short")], "doc_id string, pos int, text string")

    def call(model, question):
        return "```json\n" + models.listed_terms(model, question) + "\n```" if "=" in question else "no JSON at all"

    front = spark.createDataFrame([("a", 'meta = "x"')], "doc_id string, text string")
    p = models.ModelProvider(Service(call, ["m"]), store, "List terms.", "Give metadata.", front)
    terms = p.terms(chunks).collect()
    assert [(t["doc_id"], t["pos"], t["term"], t["domain"]) for t in terms] == [("a", 1, "Creep", ["nuclear"])]
    assert [r["dc_title"] for r in p.metadata(chunks).collect()] == [None]
    assert {(r["instance"], r["detail"]) for r in p.problems().collect()} == {("b", "form")}
    assert models.ModelProvider(Service(call, ["m"]), store, "", "").metadata(chunks) is None
    assert models.scripted({"x": "1"})("m", "has x") == "1"


def test_ingest_promotes_a_models_terms(spark, tmp_path):
    xml = "<dmodule><content><procedure><mainProcedure><para>Creep = Slow growth of strain under load / 일정한 하중에서 변형이 느리게 자라는 현상</para></mainProcedure></procedure></content></dmodule>"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(xml)
    store = Store(spark, f"file://{tmp_path}/store")
    p = models.ModelProvider(Service(models.listed_terms, ["m"]), store, "List terms.", "")
    r = pipeline.ingest_folder(spark, f"file://{tmp_path}/in", "2024-01-01T00:00:00Z", provider=p, target=store)
    assert r.summary().first()["promoted_terms"] == 1 and r.warnings == []
    store.views()
    assert [tuple(x) for x in spark.sql("SELECT term_kind, term_key, definition_en FROM ssot_terms").collect()] == [("class", "creep", "Slow growth of strain under load")]


def test_strategies_from_sql_and_by_suffix(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<note>Some text</note>")
    (tmp_path / "b.xml").write_text("<note>")
    (tmp_path / "c.xlsx").write_bytes(office.sheet_bytes(["k"], [["v"]]))
    (tmp_path / "d.pptx").write_bytes(office.slides_bytes([[(True, "Head")]]))
    (tmp_path / "e.lines").write_text("x\ny")
    (tmp_path / "f.pdf").write_bytes(b"no")

    def lines(path, doc_id, content):
        for i, line in enumerate(content.decode().split("\n")):
            if line == "y":
                raise ValueError("y")
            yield i, line, None

    known = strategies.register(spark, {"lines": strategies.Strategy(("lines",), "n int, line string, problem string", lines)})
    scanned = files.scan(spark, f"file://{tmp_path}", "*.*")
    got = {(r["strategy"], r["kind"], r["text"], r["problem"] is not None) for r in strategies.parsed(scanned, known).collect()}
    assert got == {("xml", "paragraph", "Some text", False), ("xml", None, None, True), ("sheets", "record", json.dumps({"k": "v"}), False), ("slides", "title", "Head", False), ("pdf", None, None, True)}
    scanned.where("suffix = 'lines'").createOrReplaceTempView("line_files")
    own = spark.sql("SELECT b.* FROM line_files f, LATERAL parse('lines', f.path, f.doc_id, f.content) b")
    assert own.columns == ["n", "line", "problem"] and sorted(map(tuple, own.collect()), key=str) == [(0, "x", None), (None, None, "ValueError: y")]
    with pytest.raises(Exception, match="no strategy"):
        spark.sql("SELECT * FROM parse('odd', '', '', X'00')").collect()


def test_counters_come_with_the_work(spark, caplog):
    c = tracing.Counters(spark, "run")
    rows = c.watch("parse", spark.range(10).selectExpr("id", "if(id % 3 = 0, 'bad', null) as error", "id as n"), added="n")
    assert rows.where("error is null").count() == 6
    with caplog.at_level(logging.INFO, "docloom"):
        got = {r["counter"]: r["n"] for r in c.rows().collect()}
    assert got == {"total": 10, "failed": 4, "succeeded": 6, "added": 27} and "parse" in caplog.text


def test_content_is_stored_once_under_two_paths(spark, tmp_path):
    """Also after a restart; once forgotten, it is new again."""
    folder, store = tmp_path / "in", Store(spark, f"file://{tmp_path}/store")
    folder.mkdir()
    article = "<article><front><article-meta><title-group><article-title>{}</article-title></title-group></article-meta></front><body><p>Words of it</p></body></article>".format

    def run():
        incremental.start(spark, f"file://{folder}", store, f"{tmp_path}/ck", lambda: "t", remember="30 days").awaitTermination()
        return sorted(r["t"] for r in store.read("ssot_docs").select(F.col("metadata.`dc:title`").alias("t")).collect())

    (folder / "a.xml").write_text(article("A"))
    (folder / "same.xml").write_text(article("A"))
    assert run() == ["A"]
    (folder / "later.xml").write_text(article("A"))
    (folder / "b.xml").write_text(article("B"))
    assert run() == ["A", "B"] and run() == ["A", "B"]


def plain_missed(candidates, boxes, height=800.0):
    out = []
    for c in candidates:
        hit = False
        for b in boxes:
            if b["page"] != c["page"] or len(b["text"].strip()) < 5 or None in (*b["box"], *c["box"]):
                continue
            x0, y0, x1, y1 = b["box"]
            low, high = height - y1, height - y0
            if low < 0 or high < 0:
                low, high = y0, y1
            hit |= c["box"][2] >= x0 - 5 and c["box"][0] <= x1 + 5 and c["box"][3] >= low - 5 and c["box"][1] <= high + 5
        if not hit:
            out.append((c["page"], *c["box"]))
    return sorted(out, key=str)


def test_boxes_meet_in_cells_as_in_pairs(spark):
    rng = random.Random(3)
    some = lambda: rng.choice([rng.uniform(-50, 900), float(rng.randrange(0, 900, 64)), 1e7, -1e7]) if rng.random() < 0.2 else rng.uniform(0, 800)

    def box():
        x, y = some(), some()
        b = [x, y, x + rng.choice([0, 3, 40, 700]), y + rng.choice([0, 3, 40, 700])]
        return [None if rng.random() < 0.02 else v for v in b]

    made = lambda n: [{"page": rng.randrange(3), "box": box(), "text": rng.choice(["abc", "  ab  ", "long enough"])} for _ in range(n)]
    candidates, boxes = made(120), made(60)
    candidates += candidates[:5]
    frame = lambda rows: spark.createDataFrame([("d", r["page"], *r["box"], r["text"]) for r in rows], "doc_id string, page int, x0 double, y0 double, x1 double, y1 double, text string")
    got = equations.missed(frame(candidates), frame(boxes)).select("page", "x0", "y0", "x1", "y1").collect()
    assert sorted(map(tuple, got), key=str) == plain_missed(candidates, boxes)


def test_a_page_of_very_many_boxes(spark):
    n = 300_000
    grid = spark.range(n).selectExpr("'d' as doc_id", "1 as page", "double(id % 1000) as x0", "double(id div 1000) * 2 as y0", "double(id % 1000) + 0.5 as x1", "double(id div 1000) * 2 + 0.5 as y1", "'long enough' as text")
    boxes = grid.where("x0 % 20 = 0 and y0 % 20 = 0").withColumn("page_height", F.lit(0.0))
    left = equations.missed(grid, boxes, pad=1.0)
    near = lambda c: f"(pmod({c}, 20) <= 1.5 or pmod({c}, 20) >= 18.5)"
    assert left.count() == grid.where(f"not ({near('x0')} and {near('y0')} and x0 <= 981.5 and y0 <= 581.5)").count()


def test_a_wave_reads_its_own_questions(spark, tmp_path, monkeypatch):
    plans, spread = [], models.spread
    monkeypatch.setattr(models, "spread", lambda rows: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), spread(rows))[1])
    asked = spark.createDataFrame([(f"q{i}",) for i in range(40)], "question string")
    out = models.ask(asked, Service(models.scripted({}, "{}"), ["m"]), Store(spark, f"{tmp_path}/store"), wave=20).collect()
    assert len(out) == 40 and {r["answer"] for r in out} == {"{}"}
    assert len(plans) == 2 and all("PartitionFilters: [isnotnull(wave" in p for p in plans)  # a folder, not a filter of all rows


def test_a_wave_stores_its_answers_without_a_shuffle(spark, tmp_path, monkeypatch):
    """questions are asked once each, so a wave's answers are sorted where they are, and all waves' errors are one scan."""
    plans, plain = [], type(spark.range(1)).sortWithinPartitions
    monkeypatch.setattr(type(spark.range(1)), "sortWithinPartitions", lambda rows, *by: (plans.append(plain(rows, *by)), plans[-1])[1])

    def call(model, question):
        if question.endswith("3"):
            raise ModelError(500, "down")
        return question.upper()

    store = Store(spark, f"{tmp_path}/store")
    out = models.ask(spark.range(60).selectExpr("concat('q', id) as question"), Service(call, ["m"], at_once=3), store, wave=10)
    rows = out.collect()
    assert len(plans) == 6 and not any("Exchange" in p._jdf.queryExecution().executedPlan().toString() for p in plans)
    assert sorted(r["answer"] for r in rows if r["error"] is None) == sorted(f"Q{i}" for i in range(60) if i % 10 != 3) and len(rows) == 60
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 6 + 2  # a segment a wave, the questions, the errors
    assert store.lookup("answers", out.where("answer = 'Q7'")).count() == 1


def test_questions_of_a_batch_keep_their_places():
    ring = Ring(Service(lambda m, q: q * 2, ["m"], at_once=4))
    with models.ThreadPoolExecutor(4) as pool:
        assert [r[0] for r in models.asked([str(i) for i in range(500)], ring, pool)] == [str(i) * 2 for i in range(500)] and models.asked([], ring, pool) == []
