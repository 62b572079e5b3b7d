import random
import re

import pytest

from millrace.llm import licence_texts, licences

PHRASES = {"mit license": "mit", "apache license": "apache", "a a": "aa"}
TEMPLATES = [("A", "alpha <<beginOptional>>beta <<beginOptional>>gamma<<endOptional>><<endOptional>> delta delta"),
             ("B", '<<var;name="x";original="y";match="one|two .{0,2} three|">> delta <<beginOptional>>alpha<<endOptional>> beta'),
             ("C", 'gamma <<var;name="x";match=".{1,3}">> alpha <<var;name="y";match=".{0,2}">>')]


def sequences(nodes):
    """All word sequences of a template; None stands for any word."""
    if not nodes:
        return {()}
    first, rest = nodes[0], sequences(nodes[1:])
    if isinstance(first, bytes):
        heads = {(first,)}
    elif isinstance(first, licences.Any):
        heads = {(None,) * n for n in range(first[0], first[1] + 1)}
    elif isinstance(first, licences.Maybe):
        heads = {()} | sequences(list(first))
    else:
        heads = set().union(*(sequences(list(a)) for a in first))
    return {h + r for h in heads for r in rest}


def brute(text, templates, phrases):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    base = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    accepted, covered = set(), {}
    for n, (label, markup) in enumerate(templates):
        for s in sequences(licences.parse(markup)):
            for i in range(len(w) - len(s) + 1):
                if all(b is None or a.encode() == b for a, b in zip(w[i:i + len(s)], s)):
                    accepted.add(label)
                    covered.setdefault(n, set()).add((i, i + len(s)))
    at = [i for i, _ in base]
    own = {label for _, label in base}
    return (len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(sorted(own | accepted)),
            1.0 if accepted else 0.5 if base else 0.0), covered


def scanned(spark, texts, templates, phrases):
    df = spark.createDataFrame([(i, t, "x", 1, 2.0) for i, t in enumerate(texts)], "doc_id long, text string, labels string, places int, score double")
    rows = sorted(licences.scan(df, templates, phrases).collect())
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    return rows


def test_against_all_sequences(spark):
    rng = random.Random(1)
    vocabulary = "alpha beta gamma delta delta one two three mit license apache a é".split()
    texts = [rng.choice([" ", ", ", "\n", "--"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    texts += [None, "", "...", "MIT-License", "mit licensé", "A\x00a A", "x" * 100_000 + " alpha delta delta " * 3]
    hits = 0
    for r, text in zip(scanned(spark, texts, TEMPLATES, PHRASES), texts):
        want, covered = brute(text, TEMPLATES, PHRASES)
        assert tuple(r)[1:-1] == want
        # each accepted place lies within one that was found, and what was found is accepted
        found = {(p.start, p.start + p.length) for p in r.places}
        every = set().union(*covered.values()) if covered else set()
        assert found <= every and all(any(a <= i and j <= b for a, b in found) for i, j in every)
        hits += len(every)
    assert hits > 200


def filled(markup, rng):
    """A text the template accepts, with its optional regions at random."""
    out = []
    for n in licences.parse(markup) if isinstance(markup, str) else markup:
        if isinstance(n, bytes):
            out.append(n.decode())
        elif isinstance(n, licences.Any):
            out += ["Jane", "Doe", "2024"][:max(1, n[0])]
        elif isinstance(n, licences.Maybe):
            out += filled(n, rng) if rng.random() < 0.5 else []
        else:
            out += filled(rng.choice(n), rng)
    return out


def test_all_wording_is_accepted_and_one_other_word_is_not(spark):
    rng = random.Random(2)
    texts, wanted, broken = [], [], []
    for label, markup in licence_texts.TEMPLATES:
        for _ in range(3):
            words = filled(markup, rng)
            texts.append("Some words before. " + " ".join(w.title() for w in words) + ", and after.")
            wanted.append(label)
        anchor = b" ".join(licences.Template(label, markup).anchor).decode().split()
        at = rng.randrange(len(anchor))
        whole = " ".join(w.lower() for w in words)
        changed = whole.replace(" ".join(anchor), " ".join([*anchor[:at], "other", *anchor[at + 1:]]))
        assert changed != whole
        broken.append((label, changed))
    rows = scanned(spark, texts + [t for _, t in broken], licence_texts.TEMPLATES, licence_texts.PHRASES)
    for r, label in zip(rows, wanted):
        assert label in r.labels.split(",") and r.score == 1
    for r, (label, _) in zip(rows[len(wanted):], broken):
        assert label not in [p.label for p in r.places]


def test_notices_name_the_right_version():
    compiled = licences.compiled(tuple(licence_texts.TEMPLATES))

    def labels(text):
        return licences._scanned(text.encode(), compiled, [])[5]
    assert labels("This work is licensed under the GNU General Public License, version 3.") == "GPL-3.0"
    assert labels("under the GNU General Public License version 2 or (at your option) any later version") == "GPL-2.0,GPL-2.0-or-later"
    assert labels("Licensed under CC BY-NC 4.0.") == "CC-BY-NC-4.0"
    assert labels("Released under the MIT License.") == "MIT" and labels("the MIT License") == ""
    assert labels("Licensed under the Apache License, Version 2.1") == ""


def test_no_rows(spark):
    assert scanned(spark, [], TEMPLATES, PHRASES) == []


@pytest.mark.parametrize("markup", ["a <<beginOptional>>b", "a<<endOptional>>", "<<beginOptional>>a<<endOptional>>", "a <<thing>> b",
                                    'a <<var;name="x">> b', 'a <<var;name="x";match=".{1,99999}">> b', ""])
def test_unsound_templates(markup):
    with pytest.raises(ValueError):
        licences.Template("X", markup)
