import random

import pandas as pd
import pyarrow as pa

from baflow.llm import decontam
from baflow.llm.queries import QUERIES
from tests.llm.helpers import SMALL, documents, odd_documents


def infix(item, text):
    row = [0] * (len(text) + 1)
    for k, x in enumerate(item, 1):
        new = [k]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row[1:], default=99)


def test_edit_distance():
    rng = random.Random(0)
    for _ in range(400):
        a, t = ("".join(rng.choice("abc") for _ in range(rng.randint(lo, 16))) for lo in (1, 0))
        assert decontam.infix_distance(a, t, 98)[0] == min(infix(a, t), 99)


def _edit(rng, text, share):
    s = list(text)
    for _ in range(int(share * len(s))):
        k, kind = rng.randrange(len(s)), rng.random()
        if kind < 0.4:
            s[k] = rng.choice("abcdefghij ")
        elif kind < 0.7:
            del s[k]
        else:
            s.insert(k, rng.choice("abcdefghij "))
    return "".join(s)


def test_recall_on_edited_items():
    rng = random.Random(3)
    items = pd.read_parquet(f"{SMALL}/benchmark.parquet")
    index = decontam.Index.of(items["item_id"].tolist(), items["text"].tolist())
    hosts = [t for t in documents()["text"] if len(t) > 800][:60]
    for share, least in ((0.0, 1.0), (0.05, 0.98), (0.1, 0.95), (0.15, 0.93), (0.18, 0.9), (0.2, 0.9)):
        picks = [rng.randrange(len(items)) for _ in range(150)]
        texts = []
        for n, k in enumerate(picks):
            host = hosts[n % len(hosts)]
            at = rng.randrange(len(host))
            texts.append(f"{host[:at]} {_edit(rng, items['text'][k], share)} {host[at:]}")
        found = index.leaks(pa.array(texts), decontam.EDITS)
        hit = [items["item_id"][k] in [f[0] for f in got] for k, got in zip(picks, found, strict=True)]
        assert sum(hit) >= least * len(hit), (share, sum(hit))


def test_query_finds_exact_items(spark):
    got = QUERIES["op3_cgk_decontamination"](spark, SMALL).toPandas().set_index("doc_id")
    docs, items = documents(), pd.read_parquet(f"{SMALL}/benchmark.parquet")
    plain = [(i, " ".join(decontam.normal_words(t))) for i, t in zip(items["item_id"], items["text"], strict=True)]
    assert len(got) == len(docs)
    for i, t in zip(docs["doc_id"], docs["text"], strict=True):
        text = " ".join(decontam.normal_words(t))
        assert {k for k, item in plain if item in text} <= set(got.loc[i, "item_ids"])


def test_odd_rows_slices_and_empty(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, "the cat and the dog the cat and the dog"), (2, None), (3, ""), (None, "x y"), (4, "zebra")],
                                  "item_id long, text string")
    for size in (decontam.INDEX_BYTES, 2000):
        got = decontam.find_leaks(docs, items, index_bytes=size).collect()
        assert {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in got if r["leaks"]} == {5: [1]}
        assert len(got) == docs.count()
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontam.clean(docs, items.where("false")).count() == docs.count()
    assert decontam.clean(docs.where("false"), items).count() == 0


def test_short_words_and_scripts_without_blanks_in_long_documents():
    rng = random.Random(5)
    hosts = [t for t in documents()["text"] if len(t) > 800][:20]
    items = ["How do you get to the sea if it is far to go?", "Is it so? We do not go to encyclopaedia by bus, or do we?",
             "从北京到上海最快的火车需要多少个小时才能到达终点站", "to be or not", "go up", "海",
             "在春天里，" * 3 + "人们常常到河边去看花，也会在那里吃饭、唱歌、谈天说地，直到太阳下山才慢慢走回家"]
    index = decontam.Index.of(list(range(len(items))), items)
    texts, want = [], []
    for host in hosts:
        for k, item in enumerate(items):
            at = rng.randrange(len(host))
            texts.append(host[:at] + (f"这里是一段很长的话{item}然后继续说下去" if ord(item[0]) > 1000 else f" {item} ") + host[at:])
            want.append(k)
    found = index.leaks(pa.array(texts), decontam.EDITS)
    assert all(k in [f[0] for f in got] for k, got in zip(want, found, strict=True))
    edited = [hosts[k % 20] + " " + _edit(rng, items[0], 0.05) + " " + hosts[-1] for k in range(100)]
    assert sum(bool([f for f in got if f[0] == 0]) for got in index.leaks(pa.array(edited), decontam.EDITS)) >= 95
    assert not any(f[0] in (0, 1, 2, 6) for got in index.leaks(pa.array(hosts), decontam.EDITS) for f in got)


def test_recall_on_long_items_with_inserted_words():
    rng = random.Random(6)
    pool = sorted({w for t in documents()["text"][:60] for w in decontam.normal_words(t) if w.isalpha()})
    items = [" ".join(rng.choice(pool) for _ in range(n)) for n in (150, 400, 1000, 2500)] + ["人们常到河边看花" * 200]
    index = decontam.Index.of(list(range(len(items))), items)
    host = " ".join(rng.choice(pool) for _ in range(300))
    texts, want = [], []
    for k, item in enumerate(items[:4]):
        for gap in (6, 12, 25):
            w = item.split(" ")
            copy = " ".join(x for j in range(0, len(w), gap) for x in [*w[j:j + gap], "q"])
            texts += [f"{host} {copy} {host}", copy]
            want += [k, k]
    texts.append(f"{host}{items[4]}{host}")
    want.append(4)
    found = index.leaks(pa.array(texts), decontam.EDITS)
    assert [k for k, got in zip(want, found, strict=True) if k not in [f[0] for f in got]] == []
    # a part of a long item alone is no leak
    assert not any(index.leaks(pa.array([f"{host} {items[2][:1500]} {host}", host]), decontam.EDITS))


def test_reports_equal_brute_force_distances():
    rng = random.Random(8)
    items = pd.read_parquet(f"{SMALL}/benchmark.parquet")["text"].tolist()[:12]
    index = decontam.Index.of(list(range(len(items))), items)
    plain = [" ".join(decontam.normal_words(t)) for t in items]
    for k, item in enumerate(items):
        for share in (0.0, 0.1, 0.18):
            text = f"before it {_edit(rng, item, share)} and after"
            want = infix(plain[k], " ".join(decontam.normal_words(text)))
            got = {i: d for i, d, _ in index.leaks(pa.array([text]), decontam.EDITS)[0]}
            assert want > decontam.EDITS * len(plain[k]) or got.get(k, want) == want
            assert set(got) <= {j for j, t in enumerate(plain) if infix(t, " ".join(decontam.normal_words(text))) <= decontam.EDITS * len(t)}


def test_index_takes_the_room_it_is_cut_for():
    rng = random.Random(9)
    items = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.choice((5, 40, 300, 3000)))) for _ in range(1500)]
    index = decontam.Index.of(list(range(len(items))), items)
    held = sum(x.nbytes for s in index.seeds for x in (s.key, s.item, s.place, s.same)) + index.key.nbytes + index.part.nbytes
    cost = sum(len(t.encode()) * decontam.RUN_COST + (1 + len(t) / decontam.PART) * decontam.WALKS * decontam.TABLES * decontam.KEY_COST
               for t in items)
    assert held <= 1.1 * cost
