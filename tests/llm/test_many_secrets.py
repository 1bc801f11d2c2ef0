"""Texts with many hits of each kind, and short matches that are no secrets."""

import hashlib
import re

from voltframe.llm import secrets


def hidden(text, spans):
    gone = [False] * len(text)
    for s, e in spans:
        gone[s:e] = [True] * (e - s)
    return re.sub("￾+", "[SECRET]", "".join("￾" if g else c for c, g in zip(text, gone, strict=True)))


def base(text):
    out = [(m.start(), m.end()) for m in re.finditer("(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[1]) >= 8]
    out += [(m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return out + [(m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]


def test_many_hits_of_each_kind(spark):
    keys = [f"AKIA{i:012d}" for i in range(60)]
    digests = [hashlib.md5(str(i).encode()).hexdigest() for i in range(60)]
    texts = [
        " ".join(keys),
        " ".join(x + "Q" for x in keys),
        "short AKIA1 then " + " AKIA2 ".join(keys) + " AKIA345",
        " ".join(digests),
        " abc123 ".join(digests) + " 0123456789abcdef",
        " x ".join(f"secret=value{i:04d} token=a{i}" for i in range(60)),
        " ".join(f"{k} {d} password: hunter{i:04d} AKIA{i} token=ab" for i, (k, d) in enumerate(zip(keys, digests, strict=True))),
        secrets.BLANKS + "\U00010000 token=abcdefgh \0 " + keys[0],
    ]
    # a model that calls nothing random: what is left are the fixed patterns
    model = [-1.0] * len(secrets.ALPHABET) ** 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scanned = {r["doc_id"]: r["spans"] for r in secrets.scan(df, model).collect()}
    masked = {r["doc_id"]: r["text"] for r in secrets.redact(df, model).collect()}
    for i, t in enumerate(texts):
        assert sorted(tuple(map(int, x.split(":")[1:])) for x in scanned[i].split(",")) == sorted(base(t)), i
        assert masked[i] == hidden(t, base(t)), i
    assert not any(k in x for x in masked.values() for k in keys + digests)
    # the default model adds no span over what a base span has
    for r in secrets.scan(df).collect():
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(","))]
        taken = [x for x in spans if x[0] != "markov"]
        assert not any(k == "markov" and s < y[2] and y[1] < e for k, s, e in spans for y in taken)
