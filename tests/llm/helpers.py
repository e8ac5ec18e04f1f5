"""Small documents and plain re-implementations to compare with."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def upper(text):
    return "".join(chr(ord(c) - 32) if "a" <= c <= "z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}{rng.choice('abcdé')}" for _ in range(n))


def frame(spark, texts, schema=SCHEMA):
    """Rows of documents from {id: text} or [(id, text)]."""
    pairs = texts.items() if isinstance(texts, dict) else texts
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t)) for i, t in pairs], schema)


def edited(rng, text, every):
    parts = text.split(" ")
    for i in range(every // 2, len(parts), every):
        parts[i] = f"edit{rng.randrange(10**6)}"
    return " ".join(parts)


def corpus(seed=1):
    """Ids with texts that hold copies, near copies, shared passages, odd white space and empty texts."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(5, 200)) for _ in range(30)]
    passage = prose(rng, 70)
    texts = {i: t for i, t in enumerate(base)}
    texts |= {100 + i: edited(rng, base[i], 40) for i in range(12)}
    texts |= {200 + i: base[i].upper().replace(" ", "\t\n") for i in range(6)}
    texts |= {300 + i: prose(rng, 150) + " " + passage + " " + prose(rng, 20 * i) for i in range(6)}
    texts |= {400: None, 401: "", 402: " \n\t", 403: "one two", 404: "ONE  two", 405: "one two three", 406: "ж" * 700, 407: "ж" * 650}
    long = prose(rng, 12_000, 10**6)
    texts |= {500: long, 501: edited(rng, long, 200), 502: base[3] + " " + long[:3000]}
    return texts
