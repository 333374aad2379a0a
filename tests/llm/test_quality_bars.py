"""The quality bars cover all trusted documents, whatever the model's sample is."""

import math
import random

from lumenlog.llm import quality


def test_bars_cover_all_trusted_documents(spark):
    rng = random.Random(8)
    alphabet = {"aa": "abcdefgh", "bb": "mnopqrst"}
    docs = []
    for k in range(1500):
        lang = "bb" if k % 10 == 0 else "aa"        # 150 documents, about 30 in a sample of 300
        words = ["".join(rng.choices(alphabet[lang], k=rng.randint(2, 7))) for _ in range(rng.randint(20, 60))]
        docs.append((k, " ".join(words), lang))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(1500)], "doc_id long, quality int, toxic int")
    sample = quality.trusted_ids(quality.good_ids(labels), 300).join(df.where("lang = 'bb'"), "doc_id").count()
    assert 0 < sample < quality.MIN_LANG
    got = quality.classify(df, labels, most=300).collect()
    assert len(got) == len(docs)
    found = {}
    for lang in alphabet:
        values = sorted(math.log10(r.perplexity) for r in got if r.lang == lang)
        bar = {round(math.log10(r.bar), 9) for r in got if r.lang == lang}
        assert len(bar) == 1
        found[lang] = bar.pop()
        # the quantile over every trusted document of the language, not over the sample's
        assert abs(found[lang] - quality.MARGIN - values[math.ceil(quality.QUANTILE * len(values)) - 1]) < 1e-6
    assert found["aa"] != found["bb"]
