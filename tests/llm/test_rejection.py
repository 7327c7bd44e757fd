"""Junk and languages that were not learned are rejected, labelled rows are not."""

from __future__ import annotations

import base64
import random

from chanlake.llm import langid
from chanlake.llm.ship import ship


UNLEARNED = [
    "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
]


def test_junk_and_unlearned_languages_are_rejected(spark):
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(langid.has_letters("text"))
    model = langid.train(docs.filter("doc_id % 5 <> 0").select("doc_id", "text", "lang"))
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10)))
    junk = [" ".join(word() for _ in range(n)) for n in (3, 10, 50, 300, 2000) for _ in range(8)]
    junk += [base64.b64encode(rng.randbytes(n)).decode() for n in (30, 300, 3000)]
    odd = spark.createDataFrame(list(enumerate(junk + UNLEARNED)), "doc_id long, text string")
    assert [r.text for r in langid.identify(odd, model).collect() if not r.rejected] == []
    for part in ("doc_id % 5 = 0", "doc_id % 5 <> 0"):
        found = langid.identify(docs.filter(part), model)
        assert found.filter("NOT rejected").count() > 0.99 * found.count()
