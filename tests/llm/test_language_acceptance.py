"""The pipeline's language stage on texts of scripts that the labels don't hold."""

from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import language_id


def test_foreign_script_goes_and_clean_text_stays(spark, sf_dir, docs_of):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    foreign = ["日本語の文章です。これは試験です。", "это русский текст без перевода", "中文 the 文本 内容 很 多", "123 !?"]
    added = docs_of([(10**9 + i, t) for i, t in enumerate(foreign)]).withColumn("lang", F.lit(None).cast("string"))
    first = dict(corpus_pipeline.STAGES)["language_id"](spark, docs.unionByName(added.select(docs.columns)), sf_dir)
    assert sorted(r.doc_id for r in first.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_unknown_letters_get_the_commonest_language_and_are_rejected(docs_of):
    train = docs_of([(1, "the house and the garden"), (2, "das haus und der garten am see")])
    train = train.withColumn("lang", F.when(F.col("doc_id") == 1, "en").otherwise("de"))
    model = language_id.learn(train)
    scorer = language_id.Scorer(model)
    assert scorer.predict("слово") == ("de", 0.5) and scorer.predict("слово house")[0] == "en"
    assert scorer.predict("² 12 !") == ("und", 0.0) == scorer.predict("")
    unknown = docs_of([(1, "слово мир"), (2, "the garden"), (3, "²")])
    assert {r.doc_id: r.lang_pred for r in language_id.identify(unknown, model).collect()} == {1: "de", 2: "en", 3: "und"}
    assert [r.doc_id for r in language_id.accepted(unknown, model).collect()] == [2]


def test_a_language_of_few_documents_keeps_its_entries(docs_of):
    """Entries are cut per language, so thousands of words of one don't push out the few of another."""
    rows = [(i, " ".join(f"w{chr(97 + i % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(100))) for i in range(400)]
    rows += [(1000 + i, "naran bolor tenger") for i in range(4)]
    train = docs_of(rows).withColumn("lang", F.when(F.col("doc_id") < 1000, "xx").otherwise("yy"))
    model = language_id.learn(train, max_words=50, max_grams=50)
    assert model.languages == ("xx", "yy") and len(model.words) <= 100 and len(model.grams) <= 100
    assert language_id.Scorer(model).predict("tenger bolor")[0] == "yy"


def plain_scores(train, text, languages):
    """Sums of centred log frequencies, counted anew; nothing is cut."""
    import math
    import re
    from collections import Counter

    words, grams = {n: Counter() for n in languages}, {n: Counter() for n in languages}

    def cut(word, order):
        edged = f"^{word}$" if order > 1 else word
        return [edged[i : i + order] for i in range(len(edged) - order + 1)]

    for language, t in train:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            words[language][w] += 1
            for order in language_id.ORDERS:
                grams[language].update(cut(w, order))

    def row(tables, entry):
        size = len(set().union(*tables.values()))
        logs = [math.log((tables[n][entry] + 0.5) / (sum(tables[n].values()) + 0.5 * size)) for n in languages]
        return [x - sum(logs) / len(logs) for x in logs]

    total = [0.0] * len(languages)
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        found = [row(words, w)] if any(words[n][w] for n in languages) else []
        for order in language_id.ORDERS:
            found = found or [row(grams, g) for g in cut(w, order) if any(grams[n][g] for n in languages)]
        for i in range(len(languages)):
            total[i] += sum(f[i] for f in found) / max(1, len(found))
    return total


def test_scores_equal_a_plain_count(docs_of):
    import math

    train = [("en", "the house and the garden"), ("de", "das haus und der garten"), ("nl", "het huis en de tuin")]
    docs = docs_of(list(enumerate(t for _, t in train)))
    names = F.element_at(F.array(*(F.lit(n) for n, _ in train)), (F.col("doc_id") + 1).cast("int"))
    model = language_id.learn(docs.withColumn("lang", names))
    for text in ("the gardens", "hausgarten und tuinhuis", "xqz the", "and house garten"):
        total = plain_scores(train, text, model.languages)
        best = max(range(3), key=lambda i: total[i])
        language, score = language_id.Scorer(model).predict(text)
        assert language == model.languages[best]
        assert abs(score - 1 / sum(math.exp(t - total[best]) for t in total)) < 1e-8
