"""License labels against brute force."""

import contextlib
import io
import random
import re

import pytest

from tierline.llm import license_scan
from tierline.llm.license_scan import PHRASES, TEMPLATES, needed, size_of, template_words


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(license_scan.BETWEEN, lowered) if w]


def expected(text, templates=TEMPLATES, share=0.9):
    words = words_of(text)
    places, base = [], set()
    for phrase, label in PHRASES.items():
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += at
        base |= {label} if at else set()
    matched = []
    for number, (label, template) in enumerate(templates):
        listed = template_words(template)
        held, size = set(listed), size_of(len(listed))
        for block in range(-(-len(words) // size)):
            shared = held & set(words[block * size : block * size + 2 * size])
            if len(shared) >= needed(len(held), share):
                matched.append((size, block, number, label, shared, len(shared) / len(held)))
    kept = [
        m
        for m in matched
        if not any(
            o[0] == m[0] and abs(o[1] - m[1]) <= 1 and o[4] >= m[4] and (len(o[4]) > len(m[4]) or o[5] > m[5])
            for o in matched
        )
    ]
    labels = base | {m[3] for m in kept}
    score = 1.0 if places else max((m[5] for m in kept), default=0.0)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), score,
    )


def scanned(spark, frame, place, **options):
    rows = license_scan.scan(frame, str(place), **options).collect()
    return sorted(((row.doc_id, tuple(row)[1:]) for row in rows), key=str)


def mixed_texts():
    random.seed(3)
    vocabulary = sorted({w for _, t in TEMPLATES for w in template_words(t)})
    texts = []
    for _ in range(120):
        _, template = random.choice(TEMPLATES)
        words = template.split()
        for _ in range(random.randint(0, 2)):
            words[random.randrange(len(words))] = random.choice([*vocabulary, "Zebra", "été"])
        before = random.choices([*vocabulary, "zz", "K"], k=random.choice((0, 1, 5, 17, 40)))
        texts.append(random.choice((" ", "\n", " - ")).join([*before, *words, *before[:7]]))
    return texts


FIXED = [
    None,
    "",
    " ..\n",
    "cc",
    "CC-BY, cc by. CC/BY",
    "ccby cc BYe cc éby",
    "all rights reserved all rights all rights reserved",
    "general public licenSe",
    "GENERAL PUBLIC LICENSE general public",
    "Released under the Apache License",
    "Released under the MIT License. Licensed under the Apache License, Version 2.0.",
    "word " * 5000 + "Released under the MIT License" + " word" * 5000,
    "licensed under cc by " * 700,
]


def test_equals_brute_force(spark, documents, tmp_path):
    texts = [*FIXED, *mixed_texts()]
    rows = [*enumerate(texts), (None, texts[-1]), (3, texts[-1]), (20, texts[20])]
    got = scanned(spark, documents(*rows), tmp_path)
    assert got == sorted(((i, expected(t)) for i, t in rows), key=str)
    assert len({labels for _, (*_, labels, _) in got}) > 12


@pytest.mark.parametrize("share", [0.5, 1.0])
def test_other_shares(spark, documents, tmp_path, share):
    rows = list(enumerate(mixed_texts()))
    got = scanned(spark, documents(*rows), tmp_path, share=share)
    assert got == sorted(((i, expected(t, share=share)) for i, t in rows), key=str)


def test_without_templates_or_rows(spark, documents, tmp_path):
    frame = documents((1, "Released under the MIT License, all rights reserved"))
    assert scanned(spark, frame, tmp_path / "a", templates=()) == [
        (1, (8, 1, 5, 5, "reserved", "reserved", 1.0))
    ]
    assert scanned(spark, frame, tmp_path / "b", templates=(), phrases={})[0][1][4:] == ("", "", 0.0)
    assert scanned(spark, frame.limit(0), tmp_path / "c") == []
    with pytest.raises(ValueError):
        license_scan.scan(frame, str(tmp_path / "d"), templates=[("é", "é")])


def test_no_python_on_the_executors(spark, documents, tmp_path):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        license_scan.scan(documents((1, "a")), str(tmp_path)).explain("formatted")
    assert not re.search("Python|Arrow|Pandas", text.getvalue())
