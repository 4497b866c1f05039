"""The rows of every stage of the pipeline's run against plain versions, chained, on a whole small table."""

import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import pyarrow as pa
import test_ngram_join
import test_packing
import test_quality
from texts import words

from txrisk.llm import packing, queries

SF = "/root/testdata/sf0.001"


def good(text):
    m = test_quality.brute(text)
    if m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]:
        return False
    return (all(m[f"dup_chars_{n}"] <= most * m["word_chars"]
                for n, most in {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}.items())
            and m["n_dup_lines"] <= 0.30 * m["n_lines"] and m["dup_line_chars"] <= 0.20 * m["line_chars"])


def within(a, b, most):
    """Whether the edit distance is ``most`` or less: rows of the matrix near its diagonal."""
    far = most + 1
    row = {j: j for j in range(min(most, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            new[j] = i if j == 0 else min(row.get(j, far) + 1, new.get(j - 1, far) + 1, row.get(j - 1, far) + (x != b[j - 1]))
        if min(new.values()) > most:
            return False
        row = new
    return row.get(len(b), far) <= most


def new_lines(rows):
    """Texts without lines that equal an earlier one, or are within 2 edits or a twentieth of the longer one."""
    seen = [(i, n, x) for i, t in rows.items() if t is not None for n, x in enumerate(t.split("\n"))
            if x.strip(" \t\n\v\f\r") or len(x) >= 20]
    distinct = sorted({x for _, _, x in seen}, key=lambda x: (len(x), x))
    root = {x: x for x in distinct}
    chars = {x: Counter(x) for x in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for at, b in enumerate(distinct):
        most = max(2, len(b) // 20) if len(b) >= 20 else 0
        for a in reversed(distinct[:at]):
            if len(b) - len(a) > most:
                break
            # an edit takes one character from a line at most
            if find(a) != find(b) and (chars[b] - chars[a]).total() <= most and within(a, b, most):
                root[find(a)] = find(b)
    first: dict = {}
    for i, n, x in sorted(seen):
        first.setdefault(find(x), (i, n))
    gone = {(i, n) for i, n, x in seen if first[find(x)] != (i, n)}
    out = {}
    for i, t in rows.items():
        if any(i == j for j, _ in gone):
            t = "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
            if not words(t):
                continue
        out[i] = t
    return out


def copies(rows, source):
    con = duckdb.connect()
    ids = sorted(rows)
    con.register("documents", pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array([rows[i] for i in ids], pa.string()),
                                        "source": pa.array([source[i] for i in ids], pa.string())}))
    got = con.sql(queries.oracle_sql()["op2_source_mix"]).select("doc_id, size, taken").fetchall()
    return {i: int(taken / size + 0.5) for i, size, taken in got if size}


def test_run_equals_plain_versions(spark, monkeypatch):
    real, outs = corpus_pipeline.written, []

    def spy(df, name):
        outs.append(real(df, name))
        return outs[-1]
    monkeypatch.setattr(corpus_pipeline, "written", spy)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    source = {r.doc_id: r.source for r in docs}
    assert len(source) == len(docs)
    corpus_pipeline.run(spark, SF)
    got = [Counter((r.doc_id, r.text) for r in o.collect()) for o in outs[:4]]

    rows = {r.doc_id: r.text for r in docs if good(r.text)}
    assert got[0] == Counter(rows.items())
    rows = new_lines(rows)
    assert got[1] == Counter(rows.items())
    rows = {i: rows[i] for i, (_, least) in test_ngram_join.brute(list(rows.items())).items() if i == least}
    assert got[2] == Counter(rows.items())
    times = copies(rows, source)
    assert got[3] == Counter({(i, rows[i]): n for i, n in times.items() if n})

    from tokenizers import Tokenizer
    t = Tokenizer.from_file(test_packing.JSON)
    want: Counter = Counter()
    for i, n in times.items():
        ids = np.array([*t.encode(rows[i], add_special_tokens=False).ids, packing.END_ID], "<u4")
        for p, (s, e) in enumerate(packing.cut_points(len(ids), 1024)):
            want[i, p, s, e - s, zlib.crc32(ids[s:e].tobytes())] += n
    packed = outs[4].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == +want
    held: dict = {}
    for r in packed:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in held.values():
        x.sort()
        assert [o for o, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))] and sum(n for _, n in x) <= 1024
    assert len(held) <= test_packing.best_fit([r.length for r in packed], 1024) + 1
