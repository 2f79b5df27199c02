import hashlib
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from baflow.llm import pii
from baflow.llm.queries import QUERIES
from tests.llm.helpers import SMALL, documents, odd_documents

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p) > 255 for p in m.group().split("."))) or (
                    kind == "card" and not (12 <= len(d) <= 19 and pii.luhn(d))) or (kind == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from("ab12 .@-+%_()45/:é"), max_size=70))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("0123456789  .-+"), max_size=70))
def test_base_spans_of_numbers(text):
    assert pii.base_spans(text) == plain(text)


def test_query_on_whole_table(spark):
    got = {r["doc_id"]: r for r in QUERIES["op7_boosted_pii"](spark, SMALL).collect()}
    docs = documents()
    assert len(got) == len(docs)
    for i, t in zip(docs["doc_id"], docs["text"], strict=True):
        base = plain(t)
        assert got[i]["base_sha256"] == hashlib.sha256(pii.digest(base).encode()).hexdigest()
        assert set(filter(None, pii.digest(base).split(","))) <= set(got[i]["spans"].split(","))
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]


def test_loose_forms_are_added(spark):
    from baflow.llm.common import read
    model = pii.train(read(spark, "/root/testdata/sf0.01", "documents"))
    for text, want in (("mail john at example dot com now", "john at example dot com"), ("call (415) 555-2671 now", "(415) 555-2671")):
        assert [text[a:b] for _, a, b in model.spans(text)[1]] == [want]
    for text in ("on 12-11-2024 we met", "version 1.2.3.4567 it is", "at the of. Then", "0" * 6000 + ".1.1.1"):
        base, every = model.spans(text)
        assert base == every


def test_long_runs_take_linear_time(spark):
    from baflow.llm.common import read
    model = pii.train(read(spark, "/root/testdata/sf0.01", "documents"))
    size = 2_000_000
    for run in ("a", "7", "ab.", "1 ", "1.", "+1", "a@", "@a.", "a at ", " dot ", "(at) ", "+1(", "1-", "a@b.c ", "a dot b ", "5555 "):
        for head in ("", "x (at ", " dot ", "@ ", "+"):
            text = head + run * (size // len(run))
            t0 = time.time()
            base = pii.base_spans(text)
            found = pii.proposals(text)
            assert time.time() - t0 < 8, (head, run)
            assert all(lo < hi <= len(text) for _, lo, hi in base + found)
    for run in ("1 ", "4111 1111 1111 1111 ", "a@b.c ", "a at b dot c "):
        t0 = time.time()
        assert model.spans(run * (400_000 // len(run)))
        assert len(pii.training_rows(run * (400_000 // len(run)))) <= 20 * pii.TEXT_SPANS
        assert time.time() - t0 < 20, run


def test_cover():
    rng = random.Random(4)
    for _ in range(300):
        spans = [("x", a, a + rng.randint(1, 9)) for a in (rng.randint(0, 60) for _ in range(rng.randint(0, 8)))]
        cover = pii.Cover(spans)
        for lo in range(70):
            for hi in (lo + 1, lo + 5):
                assert cover.meets(lo, hi) == any(lo < c and hi > b for _, b, c in spans)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    model = pii.train(docs)
    assert pii.find(docs, model).count() == docs.count()
    out = pii.redact(docs, model)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("doc_id is null").first()["text"].startswith("mail me at [EMAIL] or [PHONE] now")
    assert out.where("text is null").count() == 1
    assert pii.find(docs.where("false"), pii.train(docs.where("false"))).count() == 0


def test_rare_kinds_are_learned_at_any_size(spark):
    rng = random.Random(2)
    some = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = [f"plain words number {k} and 12-11-20{k % 90 + 10} or v1.{k}.3 here" for k in range(800)]
    rows += [f"write to ann{k}.{some(2)}@mail{k}.example.com or call +1 415 {some(3)} {some(4)} today" for k in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id long, text string")
    for bound in (6000, 2):                             # a sample of two documents would have no span
        model = pii.train(docs, bound)
        assert model.trees is not None
        text = "mail john at example dot com now"
        assert [text[a:b] for _, a, b in model.spans(text)[1]] == ["john at example dot com"]
