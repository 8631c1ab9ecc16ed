"""Choice of the classifier's rates and of the rules' threshold inside the training fold: python tests/llm/choose.py [folder].

Rows whose crc32(doc_id) mod 5 is 0 are never read. Models are fitted on rows with 2, 3 and 4 and compared on rows with 1."""

import itertools
import os
import sys
import zlib

import numpy as np
import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from wardline.llm import classifier as C  # noqa: E402


def rows(folder):
    documents = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pandas()
    labels = pq.read_table(f"{folder}/labels.parquet", columns=["doc_id", "quality"]).to_pandas().dropna().drop_duplicates("doc_id")
    met = documents.merge(labels, on="doc_id")
    met["fold"] = [zlib.crc32(str(i).encode()) % 5 for i in met.doc_id]
    return met[met.fold > 0].sort_values("doc_id", key=lambda i: [x * 0x9E3779B97F4A7C15 % (1 << 64) for x in i])


def main(folder="/root/testdata/sf0.1"):
    found = rows(folder)
    sparse = []
    for text, y, fold in zip(found.text.fillna(""), found.quality, found.fold, strict=True):
        _, column, value = C.features([text.encode()])
        sparse.append((column.astype(np.int32), value.astype(np.float32), int(y), fold))
    fit, rest = [r[:3] for r in sparse if r[3] > 1], [r for r in sparse if r[3] == 1]
    y = np.array([r[2] for r in rest])
    print(f"{len(fit)} rows to fit, {len(rest)} to compare, {y.mean():.3f} of them good")
    for C.ALPHA, C.L1, C.L2, C.EPOCHS in itertools.product((0.3, 1.0, 3.0), (0.01, 0.1), (0.02, 0.2), (2, 6)):
        w, bias = C.train(fit)
        p = np.array([1 / (1 + np.exp(-np.clip(w[c] @ v + bias, -30, 30))) for c, v, *_ in rest])
        order = np.argsort(np.argsort(p, kind="stable"), kind="stable")
        good = y.sum()
        area = (order[y == 1].sum() - good * (good - 1) / 2) / max(1, good * (len(y) - good))
        loss = -np.mean(np.where(y == 1, np.log(np.clip(p, 1e-9, 1)), np.log(np.clip(1 - p, 1e-9, 1))))
        print(f"alpha {C.ALPHA}, l1 {C.L1}, l2 {C.L2}, epochs {C.EPOCHS}: area {area:.5f}, loss {loss:.4f}, right at {C.CUT} {np.mean((p >= C.CUT) == y):.4f}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
