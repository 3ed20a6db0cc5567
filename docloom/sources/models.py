"""Calls of language models: terms of chunks and metadata of front matter, asked for in the tasks that hold the texts.

A question is a text; equal questions are asked once. Answers are kept in a store's table under the digest
of the question, and what is there is not asked again. Questions are asked in waves of at most ``wave``: a wave's answers are
in the table before the next begins, so a lost executor costs its share of one wave at most, and a run that is
started again asks only what is still open.

Within a task, ``at_once`` calls are under way together. Models are a ring: one that is out of quota hands on to the
next, and once all are, the task waits, twice as long each time. A refused key ends the task's calls. Every question
gets a row, with an answer or an error; errors are not kept, so they are asked again by the next run.

Defined cases: null and blank texts are no questions; an answer that is not of the form asked for is an error of kind "form".
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import Lock

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.store import Store
from ..shipping import ship
from .tables import new_path, spread

ANSWERS = "digest string, answer string, model string, calls int, error string"
TERMS = "terms array<struct<term: string, term_type: string, headword_en: string, headword_ko: string, definition_en: string, definition_ko: string, domain: array<string>, context: string>>"
METADATA = (
    "dc_title string, dc_type string, dc_language string, dc_description string, dc_subject array<string>, dc_date struct<created: string, issued: string, modified: string, valid: string>, "
    "dc_identifier array<struct<scheme: string, value: string>>, contributors array<struct<name: string, entityType: string, role: string, affiliation: string, organizationType: string>>"
)
# Statuses of services that are out of quota, and that refuse a key.
QUOTA, REFUSED = (429, 503), (400, 401, 403)
#: characters of front matter that metadata are asked of, and of a chunk below which no terms are
FRONT, LEAST = 3000, 20


class ModelError(Exception):
    def __init__(self, status: int, message: str = "") -> None:
        super().__init__(f"{status} {message}".strip())
        self.status = status


@dataclass
class Service:
    """``call(model, question)`` gives an answer or raises ModelError; it is sent to the tasks, so it opens its
    connection there."""

    call: Callable[[str, str], str]
    models: list[str]
    at_once: int = 8
    rounds: int = 3
    wait: float = 1.0
    tries: int = 2


@dataclass
class Ring:
    """One task's calls: whose turn it is, and whether the key was refused."""

    service: Service
    turn: int = 0
    spent: int = 0  # models in a row that were out of quota
    refused: str | None = None
    lock: Lock = field(default_factory=Lock)

    def ask(self, question: str) -> tuple[str | None, str | None, int, str | None]:
        """(answer, model, calls, error)"""
        s, calls, failed = self.service, 0, 0
        while True:
            with self.lock:
                if self.refused:
                    return None, None, calls, self.refused
                turn, spent = self.turn, self.spent
            model = s.models[turn % len(s.models)]
            if spent >= len(s.models) * s.rounds:
                return None, model, calls, "quota"
            if spent and spent % len(s.models) == 0:
                time.sleep(s.wait * 2 ** (spent // len(s.models) - 1))
            calls += 1
            try:
                answer = s.call(model, question)
            except ModelError as e:
                with self.lock:
                    if e.status in REFUSED:
                        self.refused = f"refused: {e}"
                    elif e.status in QUOTA:
                        if self.turn == turn:  # else another call has handed on already
                            self.turn, self.spent = turn + 1, self.spent + 1
                        continue
                if e.status in REFUSED:
                    return None, model, calls, self.refused
                failed += 1
                if failed >= s.tries:
                    return None, model, calls, f"service: {e}"
                continue
            with self.lock:
                if self.turn == turn:
                    self.spent = 0
            return answer, model, calls, None


def asked(questions: list[str], ring: Ring, pool: ThreadPoolExecutor) -> list[tuple]:
    """What ``ring`` says to each; as many calls as it may make at once take questions in turn until none is left."""
    rows: list = [None] * len(questions)
    todo = iter(enumerate(questions))
    lock = Lock()

    def work(_) -> None:
        while True:
            with lock:
                i, q = next(todo, (None, None))
            if i is None:
                return
            rows[i] = ring.ask(q)

    list(pool.map(work, range(min(ring.service.at_once, len(questions)))))
    return rows


def ask(questions: DataFrame, service: Service, store: Store, table: str = "answers", wave: int = 100_000) -> DataFrame:
    """ANSWERS rows of questions (question), one for each distinct one that is not blank."""
    ship(questions.sparkSession)
    digest = F.sha2("question", 256).alias("digest")
    open_ = questions.where(strip(F.coalesce("question", F.lit(""))) != "").select(digest, "question").distinct()
    path = new_path(questions.sparkSession, "questions")
    open_.write.parquet(path)
    open_ = questions.sparkSession.read.schema(open_.schema).parquet(path)
    wanted = open_.select("digest")
    if store.exists(table):
        open_ = open_.join(store.read(table).select("digest"), "digest", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring = Ring(service)
        with ThreadPoolExecutor(service.at_once) as pool:
            for b in batches:
                rows = asked(b.column("question").to_pylist(), ring, pool)
                answer, model, calls, error = (list(c) for c in zip(*rows)) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(answer, pa.string()), pa.array(model, pa.string()), pa.array(calls, pa.int32()), pa.array(error, pa.string())], names=["digest", "answer", "model", "calls", "error"])

    waves = max(1, -(-open_.count() // wave))
    of_wave = F.expr(f"int(pmod(crc32(digest), {waves}))")
    if waves > 1:  # a folder a wave, so that a wave reads its own questions and not all of them
        path = new_path(questions.sparkSession, "waves")
        open_.withColumn("wave", of_wave).repartition(waves, "wave").write.partitionBy("wave").parquet(path)
        open_ = questions.sparkSession.read.schema("digest string, question string, wave int").parquet(path)
        of_wave = F.col("wave")
    paths = []
    for i in range(waves):
        mine = spread(open_.where(of_wave == i).select("digest", "question"))
        paths.append(new_path(questions.sparkSession, "wave"))
        mine.mapInArrow(run, ANSWERS).write.parquet(paths[-1])  # asked once, whatever is read of it
        told = questions.sparkSession.read.schema(ANSWERS).parquet(paths[-1])
        store.upsert(table, told.where("error is null"), ["digest"], ["calls"], once=True)
    out = store.read(table).join(wanted, "digest", "left_semi").select(*(c.split()[0] for c in ANSWERS.split(", ")))
    return out.unionByName(questions.sparkSession.read.schema(ANSWERS).parquet(*paths).where("error is not null"))  # one scan of all waves


def _parsed(answers: DataFrame, schema: str) -> DataFrame:
    """answers with ``said``, and an error where an answer is not of the schema's form."""
    said = F.from_json(F.regexp_extract("answer", r"(?s)(\{.*\})", 1), schema)  # models like to wrap their answers
    fine = said.isNotNull() & F.expr("try_parse_json(regexp_extract(answer, '(?s)([{].*[}])', 1)) is not null")
    return answers.withColumn("said", F.when(fine, said)).withColumn("error", F.when(F.col("error").isNull() & ~fine, "form").otherwise(F.col("error")))


class ModelProvider:
    """A provider (``providers.Provider``) that asks a service. Questions are the prompt and the text."""

    def __init__(self, service: Service, store: Store, terms_prompt: str, metadata_prompt: str, front: DataFrame | None = None) -> None:
        self.service, self.store, self.terms_prompt, self.metadata_prompt, self.front = service, store, terms_prompt, metadata_prompt, front
        self.errors: list[DataFrame] = []

    def _asked(self, rows: DataFrame, prompt: str, text: Column, schema: str, table: str) -> DataFrame:
        told = rows.withColumn("question", F.concat(F.lit(prompt + "\n\n"), text)).withColumn("digest", F.sha2("question", 256))
        answers = _parsed(ask(told.select("question"), self.service, self.store, table), schema)
        out = told.drop("question").join(answers.select("digest", "said", "error"), "digest", "left")
        self.errors.append(out.where("error is not null").select(F.col("doc_id").cast("string").alias("instance"), F.lit("model-answer").alias("type"), F.lit(502).alias("status"), F.col("error").alias("detail")))
        return out.where("said is not null")

    def terms(self, chunks: DataFrame) -> DataFrame:
        """Candidates of chunks (doc_id, pos, text)."""
        rows = self._asked(chunks.select("doc_id", "text").where(F.length(strip(F.col("text"))) >= LEAST), self.terms_prompt, F.col("text"), TERMS, "answers_terms")
        return rows.select("doc_id", F.posexplode("said.terms").alias("pos", "t")).select("doc_id", (F.col("pos") + 1).alias("pos"), "t.*").where("coalesce(trim(term), '') <> ''")

    def metadata(self, docs: DataFrame) -> DataFrame | None:
        """Metadata of the front texts (doc_id, text) given with the provider; without them, nothing is asked."""
        if self.front is None:
            return None
        rows = self._asked(self.front.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), self.metadata_prompt, F.substring("text", 1, FRONT), METADATA, "answers_metadata")
        return rows.select("doc_id", "said.*")

    def ocr(self, regions: DataFrame) -> None:
        return None

    def problems(self) -> DataFrame | None:
        out = None
        for e in self.errors:
            out = e if out is None else out.unionByName(e)
        return out


def scripted(answers: dict[str, str], default: str = '{"terms": []}') -> Callable[[str, str], str]:
    """A service for trials: the answer whose key the question holds."""

    def call(model: str, question: str) -> str:
        return next((a for k, a in answers.items() if k in question), default)

    return call


def listed_terms(model: str, question: str) -> str:
    """A service for trials that reads terms out of the text itself: ``term = definition / definition``, one a line."""
    found = []
    for line in question.splitlines():
        head, sep, tail = line.partition(" = ")
        if sep:
            en, _, ko = tail.partition(" / ")
            found.append({"term": head.strip(), "term_type": "TERM-CLASS", "headword_en": head.strip(), "definition_en": en.strip() or None, "definition_ko": ko.strip() or None, "domain": ["nuclear"]})
    return json.dumps({"terms": found}, ensure_ascii=False)
