import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shoal.llm import pii
from tests.llm import cases

# The patterns as they are stated, without any shortcut.
STATED = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_luhn(d):
    t = [int(x) for x in d][::-1]
    return (sum(t[::2]) + sum(sum(divmod(2 * x, 10)) for x in t[1::2])) % 10 == 0


def stated(text):
    out = []
    for k, p in enumerate(STATED):
        for m in p.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            ok = (k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split("."))
                  or k == 2 and 12 <= len(d) <= 19 and plain_luhn(d) or k == 3 and 9 <= len(d) <= 15)
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="aZ@@..--++ 0123456789()_é\n", max_size=60))
def test_base_spans_are_those_stated(text):
    assert pii.base_spans(text) == stated(text)


def test_long_runs_stay_fast():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1 " * 100_000, "+1" + " " * 100_000, "a1" * 100_000, "1." * 100_000):
        pii.nodes_of(text)


def exact(unary, edges, tables):
    """Marginals by enumeration."""
    n, m = unary.shape
    p = np.zeros((n, m))
    for state in np.ndindex(*[m] * n):
        e = sum(unary[i, s] for i, s in enumerate(state)) + sum(t[state[a], state[b]] for (a, b), t in zip(edges, tables))
        for i, s in enumerate(state):
            p[i, s] += np.exp(e)
    return p / p.sum(1, keepdims=True)


def test_message_passing_is_exact_on_trees():
    rng = np.random.default_rng(3)
    unary, edges = rng.normal(size=(5, 3)), [(0, 1), (1, 2), (1, 3), (3, 4)]
    tables = [rng.normal(size=(3, 3)) for _ in edges]
    assert np.abs(pii.marginals(unary, edges, tables) - exact(unary, edges, tables)).max() < 1e-2


def test_loops_stay_close():
    rng = np.random.default_rng(5)
    unary, edges = rng.normal(size=(4, 2)), [(0, 1), (1, 2), (2, 3), (0, 3)]
    tables = [0.4 * rng.normal(size=(2, 2)) for _ in edges]
    assert np.abs(pii.marginals(unary, edges, tables) - exact(unary, edges, tables)).max() < 0.05


def person(k):
    return (f"word word +1 (687) 555-{2000 + k} word a{k}b@mail.example.org and 10.0.{k % 200}.7 then 4191085147143418 "
            f"version 3.0 code x{k}y9 in {1900 + k % 100} or 17 items")


def test_operator(spark):
    rows = [(100 + k, person(k), "en", "a", 1, *cases.EXTRA) for k in range(60)]
    rows += [(500, "call +1 (687) 555-2224 or 687-555-2224. Mail Bob.lee99@host.org, BOB.LEE99(at)HOST.ORG; 7 items", "en", "a", 1, *cases.EXTRA),
             (501, "only 12 numbers 3.0 and x9", "en", "a", 1, *cases.EXTRA)] + cases.rows()
    got = pii.find(cases.docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for r in rows:
        if r[0] is None or [x[0] for x in rows].count(r[0]) > 1:
            continue
        base = stated(r[1] or "")
        g = by[r[0]]
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(sum(s[1] == k for s in base) for k in range(4))
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert g.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(g.spans.split(","))  # base spans stay
    # the repeated number and address are found by their likeness, the rest is left alone
    more = by[500]
    assert more.n_added == 2 and {s.split(":")[0] for s in more.spans.split(",")} == {"phone", "email"}
    assert by[501].n_added == 0 and all(by[100 + k].n_added == 0 for k in range(60))


def test_without_any_base_span_and_empty(spark):
    rows = [(1, "x9 12", "en", "a", 1, *cases.EXTRA), (2, None, "en", "a", 1, *cases.EXTRA)]
    assert [r.spans for r in pii.find(cases.docs(spark, rows)).collect()] == ["", ""]
    assert pii.find(cases.empty(spark)).count() == 0


def test_documents_without_base_spans(spark):
    # phone numbers are written with and without "+", addresses also obfuscated
    rows = [(100 + k, person(k) + f" or 687-555-{2000 + k} or a{k}b(at)mail.example.org", "en", "a", 1, *cases.EXTRA) for k in range(60)]
    texts = {500: "call 687-555-2224 today, that is (687) 555-2224", 501: "mail bob.lee99(at)host.org, BOB.LEE99[at]host.org",
             502: "only 12 numbers 3.0 and x9"}
    model = pii.train(cases.docs(spark, rows))
    by = {r.doc_id: r for r in pii.find(cases.docs(spark, [(i, t, "en", "a", 1, *cases.EXTRA) for i, t in texts.items()]), model=model).collect()}
    for i, text in texts.items():
        base, nodes = pii.nodes_of(text)
        assert not base
        tokens = [text[s:e] for s, _, e in nodes]
        skip, chain = pii.skip_edges(tokens), [(k, k + 1) for k in range(len(nodes) - 1)]
        p = exact(np.array([pii.shape(t) for t in tokens]) @ model["unary"], chain + skip,
                  [model["chain"]] * len(chain) + [model["skip"]] * len(skip))
        want = [f"{pii.KINDS[q.argmax() - 1]}:{s}:{e}" for q, (s, _, e) in zip(p, nodes) if q.argmax() and q.max() > pii.THRESHOLD]
        assert by[i].spans == ",".join(want)
    assert by[500].n_added == 2 and by[502].n_added == 0


def test_numbers_that_fail_their_test_stay_out(spark):
    """Precision and recall of added spans on planted documents."""
    rng = np.random.default_rng(11)

    def card(valid):
        while True:
            d = "4" + "".join(map(str, rng.integers(0, 10, 15)))
            if plain_luhn(d) == valid:
                return d

    def phone():
        return f"({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"

    rows = [(k, f"word +1 {phone()} and card {card(True)} or order {card(False)} from 10.1.{k % 250}.3 not 300.1.2.{k % 9}, "
                f"mail x{k}@host.org in {1900 + k % 99} at 10:30 for 1,234,{500 + k}, version 3.{k} code x{k}y9", "en", "a", 1, *cases.EXTRA) for k in range(200)]
    model = pii.train(cases.docs(spark, rows))
    bad, quad = card(False), "10.999.3.4"
    clean = {1000: f"order {bad} again {bad}, {bad} and {bad} {bad}", 1001: f"release {quad} and {quad} and {quad}",
             1002: "between 2019-05-06 10:30 and 1,234,567,890 words or 17 items", 1003: "x9 version 3.0 12 34"}
    found = {2000 + k: (phone(), "phone") for k in range(40)} | {3000 + k: (f"jo{k}.doe(at)mail{k}.org", "email") for k in range(40)}
    texts = clean | {i: f"please reach {t} before noon" for i, (t, _) in found.items()}
    out = pii.find(cases.docs(spark, [(i, t, "en", "a", 1, *cases.EXTRA) for i, t in texts.items()]), model=model).collect()
    right = 0
    for r in out:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        if r.doc_id in clean:
            assert not spans, (texts[r.doc_id], spans)
        for kind, s, e in spans:
            assert (texts[r.doc_id][int(s):int(e)], kind) == found[r.doc_id]
            right += 1
    assert right >= 0.95 * len(found)


def test_features_of_checks():
    valid, fails = "4191085147143418", "4191085147143419"
    assert pii.shape(valid)[-4:] == [1, 0, 0, 0] and pii.shape(fails)[-4:] == [0, 1, 0, 0]
    assert pii.shape("10.2.3.4")[-4:] == [0, 0, 1, 0] and pii.shape("10.2.3.256")[-4:] == [0, 0, 0, 1]
    assert pii.shape("10.2.3.4x")[-4:] == [0, 0, 0, 0] == pii.shape("")[-4:]
    assert pii.variants("+1 (687) 555-2224", 3) == [("(687) 555-2224", 4)] and pii.variants("+1 2345678", 3) == []
    (spoilt, label), = pii.variants(valid, 2)
    assert label == 0 and not pii.luhn(spoilt) and len(spoilt) == 16
    text = "2019-05-06 2020-05-06 10:30 2019/5/6, on 2019-05-06 (687) 555-2224"
    assert [text[s:e] for s, e in pii.candidates(text, [])] == ["10", "(687) 555-2224"]
    text = f"+1 (687) 555-2224 {fails} 12 {valid}."
    assert pii.base_spans(text) == []  # the patterns read on into the numbers beside and do not retry
    assert [text[s:e] for s, e in pii.candidates(text, [])] == ["+1", "(687) 555-2224", fails, "12", valid]
