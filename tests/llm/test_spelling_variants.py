"""Near words, forms and roots against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from tierline.llm import spelling_variants as sv


def counted(documents):
    words = Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:p] + b[p + 1 :] == a for p in range(len(b)))


def expected(documents):
    words = counted(documents)
    form, rows = {}, []
    others = {w: [o for o in words if near(w, o)] for w in words}
    for word, n in words.items():
        best = min(others[word], key=lambda o: (-words[o], o), default=None)
        form[word] = best if best is not None and words[best] >= 10 * n else None
    for word, n in words.items():
        root = word
        while form[root] is not None:
            root = form[root]
        own = form[word]
        rows.append((word, own, root, n, len(others[word]), own and words[own]))
    return sorted(rows)


def corpus():
    random.seed(11)
    frequent = ["receive", "separate", "ÉTENDUES", "aaaaaaaa", "definitely", "étendues"]
    words = []
    for word, times in zip(frequent, (2500, 240, 60, 200, 30, 30), strict=True):
        words += [word] * times
        for _ in range(40):
            place, letter = random.randrange(len(word)), random.choice("aeiézÿ")
            cut = random.choice((0, 1))
            words += [word[:place] + letter * random.choice((0, 1)) + word[place + cut :]] * random.choice((1, 2, 3, 21))
    words += ["chainab"] * 3 + ["chainabc"] * 50 + ["chainabcd"] * 800
    words += ["x" * 300] * 40 + ["x" * 299 + "y", "x" * 299, "x" * 301] * 2 + ["short", "naïf×÷ÿ"] * 3
    words += ["q" * 64, "q" * 65, "q" * 127 + "r", "q" * 128] * 2
    random.shuffle(words)
    texts = [random.choice((" ", ", ", "1", "\n")).join(words[at : at + 40]) for at in range(0, len(words), 40)]
    return [*enumerate(texts), (0, texts[0]), (None, texts[1]), (900, None), (901, ""), (902, "§ 12")]


def found(spark, documents, place, **options):
    frame = sv.spelling_variants(documents, str(place), **options)
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(row) for row in frame.collect())


def test_equals_brute_force(spark, documents, tmp_path):
    rows = corpus()
    result = expected(rows)
    assert found(spark, documents(*rows), tmp_path) == result
    # Chains of more than one link, words without near ones, and dropped letters are all there.
    assert any(form and form != root for _, form, root, *_ in result)
    assert any(n_near == 0 for *_, n_near, _ in result)


def test_several_passes_of_filters_give_the_same(spark, documents, tmp_path):
    rows = corpus()
    assert found(spark, documents(*rows), tmp_path, most_blocks=7) == expected(rows)


def test_no_words(spark, documents, tmp_path):
    assert found(spark, documents((1, None), (2, "short")), tmp_path / "a") == []
    assert found(spark, documents((1, "a")).limit(0), tmp_path / "b") == []


def test_passes_cover_all_blocks_once():
    sizes = {7: 5, 8: 1, 9: 12}
    for most in (1, 4, 100):
        given = [(s, b) for part in sv.passes(sizes, most) for s, (low, high) in part.items() for b in range(low, high)]
        assert sorted(given) == [(s, b) for s, n in sizes.items() for b in range(n)]
        assert all(sum(h - low for low, h in part.values()) <= most for part in sv.passes(sizes, most))


def test_edits_hash_like_the_words_they_make():
    words, alphabet = ["abcabcz", "zzzzaaé"], np.array(sorted(map(ord, "abczé")), np.uint64)
    made = {}
    for length, rows, places, new, hashes in sv.edits_of(sv.letters(words, 7), alphabet):
        for row, place, letter, code in zip(rows, places, new, hashes, strict=True):
            edit = words[row][:place] + (chr(letter) if letter else "") + words[row][place + 1 :]
            own = (sv.letters([edit], length) * sv._powers(length)).sum(1, np.uint64)[0]
            assert own == code and len(edit) == length
            assert (row, edit) not in made
            made[row, edit] = code
    assert (0, "abcabc") in made and (0, "bbcabcz") in made
