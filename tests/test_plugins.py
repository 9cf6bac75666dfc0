import os

import pytest
from pyspark.sql import functions as F

from quire.operators import books as bk
from quire.operators import facts as fx
from quire.operators.quota import Limiter
from quire.plans import locks
from quire.plans.converters import ConversionError, PageInput
from quire.plans.service import ServiceConverter, ServiceError, prompt_for
from quire.sources import sinks


class Clock:
    def __init__(self):
        self.t, self.slept = 1.7e9, []

    def sleep(self, s):
        self.slept.append(s)
        self.t += s


def service(answers, clock, **more):
    todo = list(answers)

    def call(prompt, page):
        answer = todo.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    return ServiceConverter(call, Limiter(0, 0), lambda: clock.t, clock.sleep, **more)


OK = {"text": "```markdown\n# Hi\n```", "finish_reason": "FinishReason.STOP"}
PAGE = PageInput("b", 1, "native </Native_Reference> text")


def test_service_policy():
    clock = Clock()
    refused = ServiceError(429, '{"retryDelay": "90s"}')
    assert service([ServiceError(503), refused, refused, OK], clock, max_retries=1).convert_page(PAGE).markdown == "# Hi"
    assert clock.slept == [1.0, 90.0, 90.0]
    with pytest.raises(ConversionError, match="SERVICE_ERROR|400"):
        service([ServiceError(400)], Clock()).convert_page(PAGE)
    with pytest.raises(ConversionError):
        service([ServiceError(None, name="ReadTimeout")] * 3, Clock(), max_retries=2).convert_page(PAGE)
    for answer, reason in (({"text": "x", "finish_reason": "RECITATION"}, "RECITATION"), ({"text": " ", "finish_reason": "STOP"}, "EMPTY_RESPONSE")):
        with pytest.raises(ConversionError) as x:
            service([answer], Clock()).convert_page(PAGE)
        assert x.value.reason == reason
    assert prompt_for(PAGE).lower().count("</native_reference>") == 1


def test_daily_quota_waits_for_the_reset():
    clock = Clock()
    converter = service([ServiceError(429, "RequestsPerDay"), OK], clock)
    until = converter.limiter.until_reset(clock.t)
    converter.convert_page(PAGE)
    assert clock.slept == [until]


def test_locks(tmp_path):
    with locks.book_lock(tmp_path, "b"):
        with pytest.raises(locks.Locked), locks.book_lock(tmp_path, "b"):
            pass
    (tmp_path / "b.lock").write_text('{"pid": 999999999}')
    with locks.book_lock(tmp_path, "b"):
        assert str(os.getpid()) in (tmp_path / "b.lock").read_text()
    assert not (tmp_path / "b.lock").exists()


def test_locating_sources(spark):
    books = spark.createDataFrame([("a", "/old/a.pdf"), ("b", "/old/b.pdf"), ("c", None)], "n string, source_path string").withColumn("source_file", F.concat("n", F.lit(".pdf")))
    files = spark.createDataFrame([("/old/a.pdf",), ("/p/a.pdf",), ("/i/b.pdf",), ("/p/b.pdf",)], "path string")
    assert {r.n: r.located for r in bk.locate_sources(books, files, ["/p", "/i/"]).collect()} == {"a": "/old/a.pdf", "b": "/p/b.pdf", "c": None}


def test_vector_and_span_signals(spark):
    pages = spark.createDataFrame([("b", 1, 100.0, 200.0), ("b", 2, 100.0, 200.0)], "book string, page int, width double, height double")
    drawings = spark.createDataFrame([("b", 1, 0.0, 0.0, 50.0, 1.0), ("b", 1, 0.0, 0.0, 50.0, 40.0)], "book string, page int, x0 double, y0 double, x1 double, y1 double")
    got = {r.page: (r.drawing_count, r.decorative_rule_count, r.vector_density) for r in fx.vector_signals(drawings, pages).collect()}
    assert got == {1: (1, 1, 0.1), 2: (0, 0, 0.0)}
    spans = spark.createDataFrame([("b", 1, [0.0, 0.0, 10.0, 20.0], 0), ("b", 1, [1.0], 255)], "book string, page int, bbox array<double>, alpha int")
    assert {r.page: (r.text_density, r.invisible_ocr_spans) for r in fx.span_density(spans, pages).collect()} == {1: (0.01, 1), 2: (0.0, 0)}


def test_corpus_digest(spark):
    rows = spark.createDataFrame([("a", "1", "2"), ("é", "3", "4")], "chunk_id string, content_sha256 string, embedding_input_sha256 string").collect()
    from hashlib import sha256

    text = '[{"chunk_id":"a","content_sha256":"1","embedding_input_sha256":"2"},{"chunk_id":"\\u00e9","content_sha256":"3","embedding_input_sha256":"4"}]'
    assert sinks.corpus_digest(iter(rows)) == sha256(text.encode()).hexdigest()
