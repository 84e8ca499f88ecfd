"""A small fixture folder with the shapes the operators must survive."""

from __future__ import annotations

import random
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq


def _sentence(rng: random.Random, vocabulary: list[str], n: int) -> str:
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def documents(seed: int = 5, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages, repeats, odd texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    texts: list[str | None] = [_sentence(rng, vocabulary, rng.randint(1, 260)) for _ in range(n)]
    passage = _sentence(rng, vocabulary, 90)
    for i in range(0, n, 5):  # a passage that many documents share, at different places
        texts[i] = f"{texts[i]} {passage}  {_sentence(rng, vocabulary, rng.randint(0, 30))}"
    base = _sentence(rng, vocabulary, 120)
    for k in range(12):  # near copies of one text, a few words changed each
        words = base.split()
        for _ in range(k % 5):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    texts += [texts[3], texts[3], texts[7].upper().replace("ß", "SS"), texts[3].replace(" ", "\n\t")]
    texts += ["", " \t\n", None, "one", "two words", "a b c d", "a b c d e", "A B C D E", "ab " * 700, "ab " * 300, "x" * 1500,
              "x" * 399, "x" * 400, "12 34 !?", passage, passage[:390], "é" * 210, "word " * 49, "word " * 50, "word " * 51]
    texts.append(_sentence(rng, vocabulary, 6000))
    texts.append(" ".join(texts[-1].split()[1000:3000]))
    ids: list[int | None] = list(range(len(texts)))
    rng.shuffle(texts)
    rows = list(zip(ids, texts))
    rows += [(5, texts[5]), (5, texts[6]), (6, "repeated id with other words " + passage), (None, passage), (None, texts[5])]
    langs, sources = ["en", "fr", None], ["s1", "s2", "s0", None, "s1", "s1"]
    return [(i, t, langs[k % 3], sources[k % 6], len(t) if t else None) for k, (i, t) in enumerate(rows)]


DOCUMENT_TYPE = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])


def write(folder: str, name: str, schema: pa.Schema, rows: list[tuple]) -> None:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    pq.write_table(pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema), f"{folder}/{name}.parquet", row_group_size=17)


def fixture_folder(rows: list[tuple] | None = None, **tables: tuple[pa.Schema, list[tuple]]) -> str:
    folder = tempfile.mkdtemp(prefix="cropflow-llm-data-")
    write(folder, "documents", DOCUMENT_TYPE, documents() if rows is None else rows)
    for name, (schema, content) in tables.items():
        write(folder, name, schema, content)
    return folder
