import random

import pytest

from bidloom.llm import decontamination as d
from bidloom.llm.tokens import words

ITEM = "A train leaves Boston with 120 passengers and travels 45 km before it reaches Salem where 30 people wait"
OTHER = "A train leaves Denver with 77 passengers and travels 9 km before it reaches Aspen where 4 people wait"


@pytest.fixture(scope="session")
def bench(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id bigint, text string")

    return make


def table(docs, items):
    return sorted(map(tuple, d.leak_table(docs, items).collect()), key=repr)


def test_copies_and_changed_values(docs_of, bench):
    fill = "the weather stays fine over the whole valley and nobody minds "
    docs = docs_of([
        (1, fill + ITEM + ". " + fill), (2, fill + OTHER), (3, fill * 3),
        # The same number stands for two different ones: not the same question with other values.
        (4, OTHER.replace("77", "4").replace("Aspen", "Denver")),
        (5, ITEM.upper()), (6, "A train leaves Boston with 120 passengers"),
    ])
    got = table(docs, bench([(10, ITEM)]))
    assert [(r[0], r[1], r[4]) for r in got if r[0] < 4] == [(1, 10, True), (2, 10, False)]
    assert all(r[2] > 0.9 for r in got if r[0] < 3) and not {4, 3, 6} & {r[0] for r in got}


def test_letter_case_does_not_matter(docs_of, bench):
    fill = "the weather stays fine over the whole valley and nobody minds "
    docs = docs_of([(5, ITEM.upper()), (6, fill + ITEM.lower()), (7, fill + ITEM.title()), (8, "Blue Paint Dries Fast"),
                    (9, ITEM.upper().replace("120", "77")), (10, fill.upper() * 3)])
    got = table(docs, bench([(10, ITEM), (11, "blue paint dries fast")]))
    assert [(r[0], r[1], r[4]) for r in sorted(got)] == [
        (5, 10, True), (6, 10, True), (7, 10, True), (8, 11, True), (9, 10, False)]
    assert all(r[2] == 1 for r in got)
    assert [r[:2] for r in table(docs_of([(1, ITEM)]), bench([(10, ITEM.upper())]))] == [(1, 10)]


def test_windows_of_placeholders(docs_of, bench):
    fill = "the weather stays fine over the whole valley and nobody minds "
    sums, table_of = "What is 3 + 4 * 12 - 7", "12 kg 7.5 31 cm 4 9 1,200 18 65 23 km 8 44"
    title = "Of Mice And Men And Other Famous American Novels From Depression Years"
    items = bench([(1, sums), (2, table_of), (3, title), (4, title.upper() + " 3 4")])
    docs = docs_of([(1, fill + sums + " " + fill), (2, fill + table_of), (3, fill + title), (4, title.upper() + " 3 4"),
                    # Other values in such a window make it another text.
                    (5, sums.replace("4", "5")), (6, " ".join(str(n) for n in range(500, 900))), (7, " ".join(reversed(title.split())))])
    got = table(docs, items)
    assert {r[:2] for r in got} == {(1, 1), (2, 2), (3, 3), (3, 4), (4, 3), (4, 4)}
    assert all(r[2] == 1 and r[4] for r in got if r[0] == r[1])


def test_one_of_two_equal_values_changed(docs_of, bench):
    item = ("Every one of the 5 boxes weighs the same as a full crate and the driver loads them all before noon so that "
            "Anna can count 5 labels while Anna waits at the gate with Anna")
    fill = "the weather stays fine over the whole valley and nobody minds "
    docs = docs_of([(1, item.replace("5 labels", "6 labels")), (2, fill + item.replace("5 boxes", "6 boxes")),
                    # A change in most places stands against another in one.
                    (3, item.replace("Anna", "Maria", 2).replace("with Anna", "with Marie")),
                    (4, "Every one of the 5 boxes weighs nothing. Anna can count 6 labels while Bob waits at the gate")])
    short = "If 5 apples cost 5 dollars how much is one apple"
    docs = docs.unionByName(docs_of([(5, short.replace("cost 5", "cost 6"))]))
    got = sorted(table(docs, bench([(1, item), (2, short)])))
    assert [(r[0], r[1], r[4]) for r in got] == [(1, 1, False), (2, 1, False), (3, 1, False), (5, 2, False)]
    n = len(item.split())
    assert [r[2] for r in got] == pytest.approx([1 - 1 / n, 1 - 1 / n, 1 - 1 / n, 10 / 11])


def test_different_texts_of_one_item(docs_of, bench):
    long = " ".join(f"long{i}" for i in range(60)).translate(str.maketrans("0123456789", "abcdefghij"))
    items = bench([(1, ITEM), (1, long), (1, "blue paint dries fast"), (None, ITEM.replace("train", "bus")), (None, long)])
    docs = docs_of([(1, ITEM), (2, "Blue paint dries fast"), (3, long), (4, ITEM.replace("train", "bus")), (5, ITEM + " " + long)])
    got = {r[:2]: r[2] for r in table(docs, items)}
    assert {(1, 1), (2, 1), (3, 1), (3, None), (4, None), (5, 1), (5, None)} <= set(got) and set(got.values()) <= {1, 17 / 19}
    assert len(got) == len(table(docs, items))


def test_placeholders():
    found = next(words(["He paid 1,200.50 dollars to Anna. Then Bob left 3 times"]))
    code, slots = d.canonical(found, d._unit_codes())
    kinds = ["num" if c == d.NUMBER else "name" if c == d.NAME else "unit" if c == d.UNIT else "" for c in code]
    assert kinds == ["", "", "num", "unit", "", "name", "", "name", "", "num", ""]
    assert [bool(s) for s in slots] == [bool(k) for k in kinds]


def test_words_over_pieces(monkeypatch):
    text = "Alpha beta. Gamma 3.5 delta\n" * 300
    whole = next(words([text]))
    monkeypatch.setattr("bidloom.llm.tokens.PIECE", 97)
    cut = next(words([text]))
    assert (whole.code == cut.code).all() and (whole.number == cut.number).all() and len(whole.code) == 1500
    assert (whole.initial == cut.initial).all() and (whole.line == cut.line).all()


def test_long_texts_and_short_items(docs_of, bench):
    rng = random.Random(4)
    fill = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200_000))
    docs = docs_of([(1, fill + " " + ITEM + " " + fill[:1000]), (2, "is blue paint dry"), (3, "blue paint"), (4, fill)])
    got = table(docs, bench([(1, ITEM), (2, "Is blue paint dry?"), (3, "blue paint")]))
    assert [(r[0], r[1]) for r in got] == [(1, 1), (2, 2), (3, 3)]


def test_one_and_two_words_match_whole_lines(docs_of, bench):
    docs = docs_of([(1, "first line\nBlue paint!\nlast"), (2, "the blue paint"), (3, "42"), (4, "x\n 42 \ny"), (5, "42 43"),
                    (6, "blue\npaint"), (7, "no line of it " * 50 + "\nblue paint\n")])
    got = table(docs, bench([(1, "blue paint"), (2, "42")]))
    assert [(r[0], r[1]) for r in got] == [(1, 1), (3, 2), (4, 2), (6, 1), (7, 1)]


@pytest.mark.parametrize("left, right", [("\u201c", "\u201d"), ("\u2018", "\u2019"), ("\u00ab\u00a0", "\u00a0\u00bb"),
                                         ("\u2014", "\u2014"), ("\u2013", "\u2026"), ("\u00a0", "\u00a0"), ("\u3000", "\u3002")])
def test_typographic_signs_end_words(docs_of, bench, left, right):
    items = ["What is the capital of the blue river state", "Is blue paint dry", ITEM]
    docs = docs_of([(i, f"He asked{left}{t}{right}and left") for i, t in enumerate(items)])
    got = table(docs, bench(list(enumerate(items))))
    assert [(r[0], r[1]) for r in got] == [(0, 0), (1, 1), (2, 2)]


def test_capitals_of_other_scripts(docs_of, bench):
    item = "the train from \u0391\u03b8\u03ae\u03bd\u03b1 to \u041c\u043e\u0441\u043a\u0432\u0430 takes 40 hours and stops in many towns"
    other = item.replace("\u0391\u03b8\u03ae\u03bd\u03b1", "\u03a0\u03ac\u03c4\u03c1\u03b1").replace("40", "12")
    got = table(docs_of([(1, item.upper()), (2, other), (3, item.lower())]), bench([(1, item)]))
    assert [(r[0], r[1]) for r in got] == [(1, 1), (2, 1), (3, 1)]


def test_shuffled_join_is_the_same(docs_of, bench, monkeypatch):
    docs, items = docs_of([(i, f"word{i} " + (ITEM if i % 3 else OTHER)) for i in range(50)]), bench([(1, ITEM), (2, OTHER)])
    one = table(docs, items)
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    assert table(docs, items) == one and len(one) == 100


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    texts = [(r.item_id, r.text) for r in items.collect()]
    planted = {(r.doc_id, i) for r in docs.select("doc_id", "text").collect() for i, t in texts if t in r.text}
    got = {(r.doc_id, r.item_id): r.coverage for r in d.leak_table(docs, items).collect()}
    assert planted <= set(got) and len(planted) > 200
    # Whatever else is reported shares most of an item's words in order.
    assert len({i for i, _ in got}) <= 1.1 * len({i for i, _ in planted})


def test_odd_rows(odd_docs, docs_of, bench):
    items = bench([(1, ITEM), (None, ITEM), (2, None), (3, ""), (4, "x"), (1, ITEM)])
    assert table(odd_docs, items) == [] and table(docs_of([]), items) == [] and table(odd_docs, bench([])) == []
    docs = docs_of([(None, ITEM), (7, ITEM), (7, ITEM), (8, None), (None, None), (9, "")], extra=["item_id", "key", "h", "at"])
    got = table(docs, items)
    assert {(r[0], r[1]) for r in got} == {(None, None), (None, 1), (7, None), (7, 1)} and len(got) == 4
    clean = d.clean_documents(docs, items)
    assert clean.columns == docs.columns and sorted(map(repr, [(r.doc_id, r.text) for r in clean.collect()])) == sorted(
        map(repr, [(8, None), (None, None), (9, "")]))
