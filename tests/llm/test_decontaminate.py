"""Templates: copies, re-parameterised copies, and what only looks alike."""

import random
import re

from docweave.llm import decontaminate as D

ITEM = "If Anna buys 12 apples at 3 dollars each and then gives Peter 4 apples, how many of the 12 apples does she keep at home for herself"
OTHER = ITEM.replace("Anna", "Maria").replace("12", "90").replace(" 3 ", " 7 ").replace("Peter", "John Smith")
MIXED = ITEM.replace("buys 12", "buys 90").replace("of the 12", "of the 31").replace("Anna", "Maria")
FILL = "some words of quite another kind stand here and go on for a while until nothing more is said about it at all"


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in D.find_contaminated(d, b, **kw).collect()}


def test_copies_and_templates(spark):
    docs = [(1, f"{FILL}. {ITEM}. {FILL}"), (9, f"{FILL} {ITEM} {FILL}"), (2, f"{FILL}. {OTHER}. {FILL}"), (3, FILL), (4, None), (5, ""), (6, " ".join(ITEM.split()[:9]) + " " + FILL), (None, ITEM), (7, ITEM.upper()), (8, f"{ITEM} {ITEM}")]
    got = found(spark, docs, [(1, ITEM), (2, None), (3, "")])
    assert {k for k in got} >= {(1, 1), (2, 1), (None, 1), (8, 1), (9, 1)}
    assert not {(3, 1), (4, 1), (5, 1), (6, 1)} & got.keys()
    assert got[1, 1].same_slots and not got[2, 1].same_slots and got[2, 1].slot_share == 1.0


def test_the_join_alone_finds_the_same(spark):
    docs = [(1, f"{FILL} {ITEM}"), (2, OTHER), (3, FILL)]
    assert found(spark, docs, [(1, ITEM)], max_filter=0).keys() == found(spark, docs, [(1, ITEM)]).keys() == {(1, 1), (2, 1)}


SENTENCES = "Anna buys 12 apples. Peter takes 4 apples from her. Anna then sells 3 apples for 2 dollars each. How many apples does Anna keep?"


def test_names_that_start_sentences(spark):
    copy = SENTENCES.replace("Anna", "Maria").replace("Peter", "John Smith").replace("12", "90")
    mixed = copy.replace("Maria then", "Ruth then").replace("does Maria", "does Eve")
    docs = [(1, copy), (2, f"{FILL}. {copy} {FILL}"), (3, f"{FILL} {copy} {FILL}"), (4, SENTENCES), (5, FILL.capitalize()), (6, mixed)]
    got = found(spark, docs, [(1, SENTENCES)], slot_share=0.95)
    assert got.keys() == {(1, 1), (2, 1), (3, 1), (4, 1)}
    assert got[4, 1].same_slots and not got[1, 1].same_slots
    assert found(spark, docs, [(1, SENTENCES)], slot_share=0.95, max_filter=0) == got


def test_the_join_alone_finds_items_of_placeholders(spark):
    sums = "12 13 14 15 apples 16 17 18 19 20"
    docs = [(1, f"{FILL} {sums} {FILL}"), (2, FILL)]
    assert found(spark, docs, [(1, sums)], max_filter=0).keys() == found(spark, docs, [(1, sums)]).keys() == {(1, 1)}


def test_inconsistent_slots_are_turned_away(spark):
    assert D.consistency([("12", "90"), ("12", "31")]) == 0.5
    assert D.consistency([]) == 1.0
    assert (1, 1) in found(spark, [(1, OTHER)], [(1, ITEM)], slot_share=1.0)
    assert (1, 1) not in found(spark, [(1, MIXED)], [(1, ITEM)], slot_share=1.0)


def test_empty_tables(spark):
    assert found(spark, [(1, ITEM)], []) == {} and found(spark, [], [(1, ITEM)]) == {}


def test_short_items_match_whole_texts_alone(spark):
    got = found(spark, [(1, "what is love"), (2, "well what is love then anyway")], [(1, "What is love?")])
    assert got.keys() == {(1, 1)}


def test_planted_passages(spark):
    """Each of the tables' passages that a plain search finds is found, and nothing else."""
    folder = "/root/testdata/sf0.01"
    items = {r.item_id: r.text.split() for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    docs = {r.doc_id: " ".join((r.text or "").split()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = {(d, i) for i, w in items.items() for d, t in docs.items() if " ".join(w[1:-1]) in t}
    got = D.find_contaminated(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert want and {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_windows_agree_however_texts_are_grouped():
    rng = random.Random(0)
    texts = [" ".join(rng.choices([*ITEM.split(), "***", "5", "km", "Bob."], k=rng.randint(0, 30))) for _ in range(40)]
    together = D.windows(texts)
    alone = [D.windows([t]) for t in texts]
    assert together[0].tolist() == [h for a in alone for h in a[0].tolist()]
    assert [together[4](i) for i in range(len(together[0]))] == [a[4](i) for a in alone for i in range(len(a[0]))]


# --- a plain version, of one pair of texts at a time ----------------------------------------------------------------------

EDGES = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def slow_tokens(text, names):
    """(template token, slot value or empty) of each token."""
    out, starts, before = [], True, None
    for piece in text.split():
        word = piece.strip(EDGES)
        if word:
            if re.fullmatch(r"[$]?\d[\d.,:/]*(?:[A-Za-z%]{1,3})?", word):
                kind = "<number>"
            elif before == "<number>" and word.lower().encode() in D.UNITS:
                kind = "<unit>"
            elif word[0].isupper() and (names or not starts):
                kind = "<name>"
            else:
                kind = word.lower()
            if kind == "<name>" and before == "<name>" and not starts:
                out[-1] = (kind, f"{out[-1][1]} {word.lower()}")
            else:
                out.append((kind, word.lower() if kind[0] == "<" else ""))
            before = kind
        starts = piece.rstrip("\"')]").endswith((".", "!", "?", ":"))
    return out


def slow_holds(text, item, similarity=0.8, slot_share=0.8):
    for names in (False, True):
        t, i = slow_tokens(text, names), slow_tokens(item, names)
        windows = [p for p in range(len(i) - D.WINDOW + 1)]
        wordy = [p for p in windows if sum(x[0][0] != "<" for x in i[p : p + D.WINDOW]) >= 2]
        windows = wordy if names else wordy or windows
        places = {}
        for q in range(len(t) - D.WINDOW + 1):
            places.setdefault(tuple(x[0] for x in t[q : q + D.WINDOW]), []).append(q)
        pairs = [(p, q) for p in windows for q in places.get(tuple(x[0] for x in i[p : p + D.WINDOW]), ())]
        if not pairs:
            continue
        lines = sorted({q - p for p, q in pairs})
        best = max(lines, key=lambda d: (sum(d <= q - p <= d + D.SLACK for p, q in pairs), -d))
        on = [(p, q) for p, q in pairs if best <= q - p <= best + D.SLACK]
        slots = {(p + k, q + k): (i[p + k][1], t[q + k][1]) for p, q in on for k in range(D.WINDOW) if i[p + k][1]}
        if len({p for p, _ in on}) / len(windows) >= similarity and D.consistency(list(slots.values())) >= slot_share:
            return True
    return False


def test_against_a_plain_version(spark):
    rng = random.Random(5)
    people, things = ["Anna", "Peter", "Maria", "John Smith", "Eve"], ["apples", "pears", "books", "stones"]
    shapes = ["{a} buys {m} {x} and gives {n} of the {m} {x} to {b}.", "{b} pays {k} dollars for {n} {x} after {a} left.", "How many {x} does {a} keep?", "If {a} walks {k} km in {n} hours, how far does {b} walk?", "{a} has {m} {x}."]
    fill = lambda s: s.format(a=rng.choice(people), b=rng.choice(people), x=rng.choice(things), m=rng.randint(1, 30), n=rng.randint(1, 30), k=rng.randint(1, 9))
    items, docs = [], []
    for n in range(30):
        chosen = rng.sample(shapes, rng.randint(1, 4))
        values = {"a": rng.choice(people), "b": rng.choice(people), "x": rng.choice(things), "m": rng.randint(1, 30), "n": rng.randint(1, 30), "k": rng.randint(1, 9)}
        items.append((n, " ".join(s.format(**values) for s in chosen)))
        other = {**values, "a": rng.choice(people), "m": rng.randint(40, 90), "n": rng.randint(40, 90)}
        docs.append((2 * n, f"{FILL}. " * rng.randint(0, 2) + " ".join(s.format(**other) for s in chosen) + f" {FILL}"))
        docs.append((2 * n + 1, " ".join(fill(rng.choice(shapes)) for _ in range(rng.randint(1, 6)))))
    want = {(d, i) for d, t in docs for i, x in items if slow_holds(t, x)}
    assert 30 <= len(want) < 1500
    assert found(spark, docs, items).keys() == want


def test_a_pattern_of_all_items_pairs_nothing(spark):
    """The rarest windows are seeds, so that a common one doesn't multiply texts by items."""
    items = [(i, f"how many apples does anna keep in box {' '.join(f'w{i}x{k}' for k in range(20))}") for i in range(50)]
    docs = [(i, f"{FILL} how many apples does anna keep in box") for i in range(50)] + [(99, items[7][1])]
    assert found(spark, docs, items).keys() == {(99, 7)}


def test_repeated_rows_versions_clashes_and_long_texts(spark):
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(1, ITEM, 1, "x"), (1, ITEM, 2, "y"), (2, f"{long} {ITEM} {long}", 3, "z"), (3, long, 4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int, h string")
    bench = spark.createDataFrame([(7, FILL, 0), (7, ITEM, 1), (7, ITEM, 2), (None, ITEM, 3)], "item_id long, text string, doc_id int")
    got = sorted((r.doc_id, r.item_id is None) for r in D.find_contaminated(docs, bench).collect())
    assert got == [(1, False), (1, False), (1, True), (1, True), (2, False), (2, True)]
    left = D.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [3]
