import hashlib
import random
import re

from lendspan.llm import decontaminate

WORD = re.compile(decontaminate.WORD)
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items):
    windows = {}
    for item, text in items:
        words = split(text)
        for at in range(max(1, len(words) - 9)):
            if words:
                windows.setdefault(tuple(words[at : at + 10]), set()).add(item)
    result = []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for win, names in windows.items():
            for at in range(len(words) - len(win) + 1):
                if tuple(words[at : at + len(win)]) == win:
                    hit.update(range(at, at + len(win)))
                    found |= {str(n) for n in names if n is not None}
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        result.append((doc, len(words), len(hit), len(found), ids, bool(hit)))
    return sorted(result, key=str)


def found(spark, docs, items):
    d = spark.createDataFrame([(*r, "c") for r in docs], "doc_id long, text string, n_words string")
    b = spark.createDataFrame([(*r, "c") for r in items], "item_id long, text string, win string")
    rows = decontaminate.contamination(d, b).drop("text_key").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "dé", "E", "f9", "ß"]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, words(rng.choice([1, 3, 9, 10, 11, 14]))) for k in range(9)] + [(9, None), (10, ""), (10, "a b"), (None, "f9 f9 f9 f9")]
    docs = [(k, words(rng.choice([0, 2, 12, 60]))) for k in range(20)]
    docs += [(50 + k, f"{words(5)}; {t}! {words(3)}") for k, (_, t) in enumerate(items) if t]
    docs += [(90, None), (None, items[3][1]), (91, items[3][1].upper()), (91, "x y"), (92, items[4][1]), (92, items[4][1])]
    assert found(spark, docs, items) == brute(docs, items)


def test_shuffled_where_the_benchmark_is_too_large_to_broadcast(spark, monkeypatch):
    docs = [(1, "one two three four five six seven eight nine ten eleven"), (2, "other words")]
    items = [(5, "two three four five six seven eight nine ten eleven"), (6, "words")]
    expected = found(spark, docs, items)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert found(spark, docs, items) == expected == brute(docs, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a b")], []) == brute([(1, "a b")], [])


def test_clean_documents_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "x a b y", 7), (2, "a c b", 8), (2, "a c b", 8), (3, None, 9)], "doc_id long, text string, start int")
    items = spark.createDataFrame([(1, "A b")], "item_id long, text string")
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == [(2, "a c b", 8), (2, "a c b", 8), (3, None, 9)]
