"""Accuracy of the subjects of held-out labelled documents: python -m nightledger.llm.held_out FOLDER [FOLDS].

Each fold's labelled documents lose their labels, the rest propagate, and what the fold's documents get is held
against their hand labels, a few of which are wrong. One JSON line.
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import functions as F

from nightledger.llm.subjects import subjects
from nightledger.session import local_session
from nightledger.sources.tables import table


def held_out(spark, folder: str, folds: int = 2) -> dict[str, float]:
    docs, areas, labels = (table(spark, folder, n) for n in ("documents", "subject_areas", "subject_labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(folds))
    right = found = given = 0
    for k in range(folds):
        got = subjects(docs, "doc_id", "text", areas, labels.where(fold != k), "doc_id", "subject").select("doc_id", "subject").distinct()
        held = labels.where(fold == k)
        got = got.join(held.select("doc_id").distinct(), "doc_id")
        truth = held.select("doc_id", "subject").where("subject is not null").distinct()
        right += got.join(truth, ["doc_id", "subject"]).count()
        found += got.count()
        given += truth.count()
    p, r = right / max(1, found), right / max(1, given)
    return {"folds": folds, "precision": round(p, 4), "recall": round(r, 4), "f1": round(2 * p * r / max(1e-9, p + r), 4), "cases": given}


if __name__ == "__main__":
    print(json.dumps({"folder": sys.argv[1]} | held_out(local_session(8), sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 2)))
