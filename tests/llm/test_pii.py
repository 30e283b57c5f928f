import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from strataframe.llm import pii as P
from strataframe.llm.queries import op2


def brute(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        odd, even = d[-1::-2], d[-2::-2]
        if 13 <= len(d) <= 19 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def check_rows(got, texts):
    """Each result row against the base spans of its text."""
    assert len(got) == len(texts)
    for r in got:
        base = brute(texts[r.doc_id] or "")
        kinds = [k for k, _, _ in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in P.BASE]
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(r.spans.split(","))
        order = [(P.KINDS.index(k), int(s)) for k, s, _ in (x.split(":") for x in r.spans.split(",") if x)]
        assert order == sorted(order)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = op2(spark, sf).collect()
    check_rows(got, texts)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got) > 20


def test_base_spans_on_random_texts():
    rng = random.Random(7)
    parts = ["a", "b.c", "@", ".", "x@y.de", "1", "255", "256", "4111111111111111", "4111 1111-1111 1111", "+", "+1 ", "(", ")", "-", " ", "é", "%", "00", "9.9.9.9", "5500005555555559"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert P.base_spans(t) == brute(t), t


def test_long_runs_take_linear_time():
    for t in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + " " * 400_000 + "2345678 9", "a@" * 200_000, "1 " * 200_000, "+" * 400_000):
        base = P.base_spans(t)
        P.candidates(t, base)
    assert P.base_spans("+1" + " " * 5000 + "2345678 9") == [("phone", 0, 5011)]


def test_added_spans_follow_the_voters(spark, rows):
    pairs = [(i, f"card visa 4111111111111111 paid, mail to a{i}@mail.com or tel +49 30 1234567") for i in range(30)]
    pairs += [(100 + i, f"api key 9abc9ff9ca9fb9e9c999a9eb99999999a999b{i:03d} kept") for i in range(30)]
    pairs += [(200, "write to john (at) mail (dot) com please"), (201, "order number 1234567890123456 isbn")]
    got = {r.doc_id: r for r in P.detect(rows(pairs)).collect()}
    assert "secret:8:48" in got[100].spans
    assert got[5].spans.startswith("email:")
    assert (got[201].n_card, got[201].spans) == (0, "")


def test_nulls_empties_ties_and_names(spark, rows):
    pairs = [(1, None), (2, ""), (None, "x@y.de"), (3, "x@y.de"), (3, "x@y.de"), (4, "z " * 200_000 + "1.2.3.4")]
    clash = rows(pairs).select("*", *[F.lit(0).alias(n) for n in ("s", "spans", "n_email", "t", "redacted")], F.lit(6).cast("long").alias("n_chars"))
    got = P.detect(clash).collect()
    assert sorted((r.doc_id or 0, r.spans) for r in got) == [(0, "email:0:6"), (1, ""), (2, ""), (3, "email:0:6"), (3, "email:0:6"), (4, "ip:400000:400007")]
    clean = P.redact(clash)
    assert clean.columns == clash.columns and clean.dtypes == clash.dtypes
    by = {r.doc_id: r for r in clean.collect()}
    assert (by[3].text, by[3].n_chars, by[1].text, by[1].n_chars, by[2].text) == ("<email>", 7, None, 6, "")
    assert P.detect(rows([])).count() == 0
    assert P.redact(rows([])).count() == 0


def test_redaction_leaves_the_rest_as_it_was():
    model = P.SpanModel()
    assert P.find_spans("nothing here at all, 12 or 7.5", model) == ([], [])


def test_expectation_maximisation_finds_the_better_voter():
    import numpy as np

    from strataframe.llm.label_model import LabelModel

    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    right = [0.95, 0.8, 0.6]
    votes = np.stack([np.where(rng.random(len(truth)) < r, truth, ~truth) * 2 - 1 for r in right], axis=1)
    votes[rng.random(votes.shape) < 0.2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = LabelModel(3).fit(patterns, counts)
    assert np.abs(model.accuracies() - right).max() < 0.06
    assert abs(model.prior - 0.3) < 0.05
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.9


@pytest.mark.parametrize("counts", [{}, {("number", (0,) * 6): 3}])
def test_models_of_little(counts):
    assert P.SpanModel().fit(counts).keeps("email", (0,) * 6)


def test_long_names_and_addresses_are_whole():
    name, local = "A" + "b" * 50, "x" * 100
    text = f"Dr. {name} wrote, {local} (at) {'h' * 80} (dot) {'museum' * 5} too"
    found = {k: text[s:e] for k, s, e in P.candidates(text, [])}
    assert found["name"] == f"Dr. {name}" and found["masked_email"].startswith(local) and found["masked_email"].endswith("museum")


def test_overlapping_candidates_all_vote_and_the_likelier_stays():
    text = "call 030 1234 5678 now, card 1234 5678 9012 3456 7"
    kinds = [(k, text[s:e]) for k, s, e in P.candidates(text, [])]
    both = "1234567890123456789a"  # a number inside a key
    assert [k for k, _, _ in P.candidates(both, [])] == ["number", "secret"]
    assert ("local_phone", "030 1234 5678") in kinds
    for likely, other in (("number", "secret"), ("secret", "number")):
        model = P.SpanModel()
        chances = {likely: 0.9, other: 0.6}
        model.chance = lambda kind, vote, c=chances: c[kind]
        assert [k for k, _, _ in P.find_spans(both, model)[1]] == [likely]


def test_no_labeler_is_constant_on_a_kind():
    texts = ["tel 030 1234 5678 or x@y.de", "page 123 456 789 of", "key aB3dE5fG7hJ9kL1mN3pQ in", "order AAAA1111AAAA1111AAAA here", "Dr. Anna Smith", "Mr Xylo wrote",
             "pay 4111 1111 1111 1112 by visa", "isbn 9781234567897 and", "a (at) b (dot) com", "zz at page dot chapter"]
    seen = {}
    for t in texts:
        base = P.base_spans(t)
        for span in P.candidates(t, base):
            seen.setdefault(span[0], set()).add(P.votes(t, span, sorted(x[1:] for x in base)))
    assert all(len(v) > 1 for v in seen.values()) and set(seen) == set(P.ADDED)


def test_added_columns_say_what_the_listing_says(spark, rows):
    pairs = [(i, f"api key 9abc9ff9ca9fb9e9c999a9eb99999999a999b{i:03d} kept, mail a{i}@mail.com") for i in range(30)]
    for r in P.detect(rows(pairs)).collect():
        kinds = [x.split(":")[0] for x in r.spans.split(",")]
        assert r.n_spans == len(kinds) and all(r[f"n_{k}"] == kinds.count(k) for k in P.KINDS)
