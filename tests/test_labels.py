import hashlib
import re

from sievework import catalogue


def test_document_labels_take_whole_texts(spark, tmp_path):
    texts = ["x" * 90 + " a@b.kr, c.d@e.org " + "y" * 50 + " z@z.zz", "😀 é a@b.kr\n", "no address " * 20, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in catalogue.QUERIES["document_labels"](spark, str(tmp_path)).collect()}
    want = set()
    for i, x in enumerate(texts):
        m = [len(v) for v in re.findall(r"[A-Za-z0-9_.+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", x)]
        want.add((i, len(x), hashlib.md5("|".join(x).encode()).hexdigest(), len(m), sum(m) - len(m), len(x) - sum(m)))
    assert got == want
