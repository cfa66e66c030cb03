"""Secrets and personal data against plain regular expressions, and the guess costs."""

from __future__ import annotations

import math
import random
import re

import pytest

from gradeline.llm import pii, secrets


def _secrets(text):
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    out = [(m.start(), m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]


def _personal(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [
        ("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]

    def luhn(digits):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0

    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


PIECES = [
    "password", "Token", "API_KEY", "apikey", "=", ": ", '"', "abc", "hunter22", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789",
    "a@b.com", "@", ".", "x.y", "1.2.3.4", "256.1.1.1", "+1 (555) 123-4567", "+", "4111111111111111", "4111 1111 1111 1111", " ", "-", "é", "\n", "00012",
]


@pytest.mark.parametrize("seed", range(4))
def test_base_spans_equal_the_patterns(seed):
    choose = random.Random(seed)
    for _ in range(1500):
        text = "".join(choose.choices(PIECES, k=choose.randint(0, 25)))
        assert secrets.base_spans(text) == _secrets(text)
        assert pii.base_spans(text) == _personal(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "a." * 100_000, "1." * 100_000 + "x", "@" * 100_000, "+1" + " (" * 100_000):
        pii.base_spans(text)
        secrets.scan(text)
    assert secrets.guess_cost("qwerty" * 3000) > 0


def test_guess_costs_are_ordered_and_least():
    cost = secrets.guess_cost
    assert cost("") == 0
    assert cost("password") < cost("passw0rd") < cost("xkqvzjwm")
    assert cost("aaaaaaaaaaaa") < cost("qwertyuiop") < cost("q8#Lz0!mKp2x")
    assert cost("1999-12-31") < 7
    for value in ("password1999", "abcabcabc", "zxcvbnm!"):
        for cut in range(1, len(value)):
            assert cost(value) <= cost(value[:cut]) + cost(value[cut:]) + 1e-9


def test_added_spans_stand_in_a_context_and_are_hard():
    text = "the passphrase is kR9#tq!Zw2pL, the pwd: password, login=qwerty123 auth => Zp81-xxQ_77vb!k"
    found = {text[s:e] for s, e, kind in secrets.scan(text) if kind == "guess"}
    assert found == {"kR9#tq!Zw2pL", "Zp81-xxQ_77vb!k"}
    assert [k for _, _, k in secrets.scan("password=abcdef12345")] == ["assign"]


def test_clean_prose_is_no_secret_by_the_words_of_the_corpus(spark):
    prose = [
        "the secret is simple", "a simple answer was incorrect", "the password is incorrect", "Login is required, said the notice",
        "the notice required nothing", "my credential is expired", "an expired and simple notice", "incorrect and required again",
        "the secret is Simple enough", "expired yesterday", "she kept it simple", "what is incorrect is required",
    ]
    hard = ["the secret is kR9#tq!Zw2pL"] + ["the passphrase is xkqvzjwmbt"] * 3
    hard += [f"copy {i}: the passphrase is xkqvzjwmbt" for i in range(3)]
    docs = spark.createDataFrame(list(enumerate([*prose, *hard, None, ""])), "doc_id long, text string")
    words = secrets.word_ranks(docs)
    ranks = {r["word"]: r["rank"] for r in words.collect()}
    assert {"simple", "incorrect", "required", "expired"} <= set(ranks) and "xkqvzjwmbt" not in ranks
    common = secrets.ranked(secrets.COMMON_WORDS)
    assert {w: r for w, r in ranks.items() if w in common} == common
    assert ranks["required"] < ranks["expired"]  # in three and two texts, values left out
    for word in set(ranks) - set(common):  # one more than the words of lower rank
        assert ranks[word] == 1 + sum(r < ranks[word] for r in ranks.values())
    rows = secrets.find_secrets(docs, words=words).collect()
    found = {r["text"] for r in rows if r["kinds"]}
    assert found == set(hard)
    assert secrets.word_ranks(docs.filter("false")).count() == len(set(secrets.COMMON_WORDS))


def _all_cuts(value, words):
    """The least cost over every way to cut a value, each segment priced on its own."""
    plain, unleet = value.lower(), value.lower().translate(secrets.LEET)

    def prices(i, j):
        yield secrets._brute(value[i]) if j == i + 1 else math.inf
        upper = float(value[i:j] != plain[i:j])
        yield math.log10(words[plain[i:j]]) + 0.5 + upper if plain[i:j] in words else math.inf
        yield math.log10(words[unleet[i:j]]) + 1.5 + upper if unleet[i:j] in words else math.inf
        yield secrets.DATE_GUESSES if secrets.DATE.fullmatch(plain[i:j]) else math.inf
        steps = [pair in secrets._NEXT for pair in zip(plain[i:j], plain[i + 1 : j])]
        yield math.log10(47) + len(steps) * math.log10(2) if len(steps) >= 2 and all(steps) else math.inf
        yield secrets.REPEAT_GUESSES if 2 * i >= j and value[2 * i - j : i] == value[i:j] else math.inf

    n = len(value)
    price = {(i, j): min(prices(i, j)) for i in range(n) for j in range(i + 1, n + 1)}
    cuts = (
        [0, *[k for k in range(1, n) if chosen >> k & 1], n] for chosen in range(0, 1 << n, 2)
    )
    return min(sum(price[a, b] for a, b in zip(cut, cut[1:])) for cut in cuts)


@pytest.mark.parametrize("seed", range(6))
def test_the_cost_is_the_least_over_all_cuts(seed):
    choose = random.Random(seed)
    words = secrets.ranked(["abc", "cab", "pass", "ass", "bcab", "spa"])
    letters = ["ab", "abcC", "019-./", "qwePas$4", "0129", "aab1"][seed]
    for _ in range(60):
        value = "".join(choose.choices(letters, k=choose.randint(1, 10)))
        assert secrets.guess_cost(value, words) == pytest.approx(_all_cuts(value, words)), value


def test_dates_and_repeats_are_found_wherever_they_are():
    cost = secrets.guess_cost
    assert cost("20191999-12-31") < 4 + secrets.DATE_GUESSES + 0.01
    unit = "x7#kQ9!mZe"
    assert cost(unit * 3) == pytest.approx(cost(unit) + 2 * secrets.REPEAT_GUESSES)
    assert cost("a" * 1024) == pytest.approx(cost("a") + 10 * secrets.REPEAT_GUESSES)


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "aaab"])
def test_periodic_stretches_are_all_found(letters):
    choose = random.Random(letters)
    for _ in range(150):
        value = "".join(choose.choices(letters, k=choose.randint(0, 24)))
        n, wanted = len(value), {}
        for p in range(1, n // 2 + 1):
            for s in range(n):
                e = s + p
                while e < n and value[e] == value[e - p]:
                    e += 1
                if e - s >= 2 * p and (s == 0 or s + p - 1 >= n or value[s - 1] != value[s + p - 1]):
                    wanted.setdefault((s, e), p)
        assert sorted(secrets.periodic_stretches(value)) == sorted((s, e, p) for (s, e), p in wanted.items())


def test_the_join_judges_values_as_the_scan_does(spark):
    """Words come to the values by a join of their pieces; long words and values of many texts too."""
    words = ["correct", "horse", "battery", "pneumonoultramicroscopicsilicovolcanoconiosis", "straße"]
    values = ["correcthorsebattery", "C0rrectHor5e", words[3], words[3] + "9", "straßehorse", "x9$kQ!z0Lm", "zxcvbnm1999"]
    texts = [f"doc {i} login is {value} here, pwd=> {value}" for value in values for i in range(3)] + ["login is " + values[0]] * 40
    docs = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id long, text string")
    rows = secrets.find_secrets(docs, words=words).collect()
    assert len(rows) == docs.count()
    ranks = secrets.ranked(words)
    for row in rows:
        spans = secrets.scan(row["text"], ranks) if row["text"] else []
        assert list(zip(row["starts"], row["ends"], row["kinds"])) == spans
        assert row["guesses"] == [secrets.guess_cost(row["text"][s:e], ranks) for s, e, _ in spans]
    assert {row["text"].split()[4] for row in rows if row["kinds"] and row["text"].startswith("doc")} == {"x9$kQ!z0Lm"}


def test_frames(spark, odd_docs, no_docs):
    found = secrets.find_secrets(odd_docs)
    assert found.count() == odd_docs.count() and found.filter("size(kinds) > 0").count() == 0
    assert secrets.find_secrets(no_docs).count() == 0
    model = pii.fit_spans(odd_docs)
    assert pii.find_personal(odd_docs, model).count() == odd_docs.count()
    assert pii.find_personal(no_docs, pii.fit_spans(no_docs)).count() == 0


def test_personal_data_is_learned_from_the_votes(spark):
    rows = [(i, f"please call {200 + i % 700}-555-{1000 + i} today, mail me: user{i}@mail.com") for i in range(300)]
    rows += [(1000 + i, f"order part no x{100 + i % 800}.111.{1111}7 of version {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_personal(docs, pii.fit_spans(docs)).collect()
    local = {r["doc_id"] for r in found if "phone_local" in r["kinds"]}
    assert len(local & set(range(300))) == 300 and not local & set(range(1000, 1300))
    for row in found:
        base = [(k, s, e) for k, s, e in zip(row["kinds"], row["starts"], row["ends"]) if k in pii.BASE_KINDS]
        assert base == _personal(row["text"])
