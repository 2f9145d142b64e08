import random

from prepspark.llm.language_id import SAMPLE_SPACE, UNKNOWN, _WORDS, sampled_below, LanguageModel, fit_languages, held_out, identify, keep_identified, predict_languages, script_of
from pyspark.sql import functions as F

EN = "the and of with that from this which there their would about people water little house".split()
DE = "und der nicht mit eine auch werden zwischen haben jedoch straße über können schön wasser haus".split()
RU = "и это не что который также между люди вода дом было только после время город".split()


def corpus(spark, rows=120):
    random.seed(1)
    kinds = [("en", EN), ("de", DE), ("ru", RU)]
    data = [(i, " ".join(random.choices(kinds[i % 3][1], k=30)), kinds[i % 3][0]) for i in range(rows)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string")


def test_held_out_rows_are_predicted(spark):
    docs = corpus(spark)
    found = identify(docs).join(docs, "doc_id").where("held_out").collect()
    assert found and all(r.lang == r.lang_pred and r.score > 0.9 for r in found)


def test_mixed_text_is_cut_where_the_language_changes(spark):
    model = fit_languages(corpus(spark))
    first, second, third = " ".join(EN), " ".join(DE), " ".join(RU)
    text = f"{first}. {second}. {third}"
    row = predict_languages(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [s.lang for s in row.spans] == ["en", "de", "ru"]
    assert text[row.spans[2].start :].startswith(RU[0]) and row.spans[-1].end == len(text)
    letters = [sum(map(len, x)) for x in (EN, DE, RU)]
    assert abs(row.score - max(letters) / sum(letters)) < 0.1


def test_viterbi_equals_a_plain_one(spark):
    model = fit_languages(corpus(spark))
    random.seed(2)
    texts = [" ".join(random.choices(EN + DE, k=random.randint(1, 12))) for _ in range(30)]
    found = model.label(texts)
    for text, (lang, _, spans) in zip(texts, found):
        words = text.split()
        rows = [model.scores[model.known[w]] for w in words]
        value, back = list(map(float, rows[0])), []
        for r in rows[1:]:
            best = max(range(3), key=lambda k: (value[k], -k))
            moved = [value[k] < value[best] - model.penalty for k in range(3)]
            back.append([best if moved[k] else k for k in range(3)])
            value = [(value[best] - model.penalty if moved[k] else value[k]) + float(r[k]) for k in range(3)]
        state = max(range(3), key=lambda k: (value[k], -k))
        path = [state]
        for b in reversed(back):
            path.append(b[path[-1]])
        path.reverse()
        cuts = [0] + [i for i in range(1, len(path)) if path[i] != path[i - 1]]
        assert [s["lang"] for s in spans] == [model.langs[path[c]] for c in cuts]


def test_odd_rows(spark, odd, empty):
    found = identify(odd)
    rows = {(r.doc_id, r.score): r for r in found.collect()}
    assert found.count() == odd.count()
    pred = [(r.doc_id, r.lang_pred, r.score) for r in rows.values()]
    assert all(lang == UNKNOWN and score == 0 for i, lang, score in pred if i in (4, 5, 6, 7))
    assert all(0 <= s <= 1 for _, _, s in pred)
    assert identify(empty).count() == 0
    model = fit_languages(odd.where(~held_out(F.col("doc_id"))))
    kept = keep_identified(odd, model)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()}.isdisjoint({4, 5, 6, 7})
    none = predict_languages(odd, fit_languages(empty))
    assert {r.lang_pred for r in none.collect()} == {UNKNOWN}


def test_full_cache_and_scripts(spark, monkeypatch):
    monkeypatch.setattr("prepspark.llm.language_id.CACHED_WORDS", 5)
    model = fit_languages(corpus(spark))
    assert [x[0] for x in model.label([" ".join(EN), " ".join(DE), None, "123"])] == ["en", "de", UNKNOWN, UNKNOWN]
    assert script_of("ж") == "cyrillic" and script_of("ß") == "latin" and script_of("漢") == "han"
    assert isinstance(model, LanguageModel) and model.scripts["cyrillic"].tolist() == [True, True, False]


def test_words_keep_marks_and_end_at_script_changes():
    assert _WORDS.findall("हिन्दी ภาษาไทย Hello中文字, e\u0301te\u0301 12 a_b привет́") == [
        "हिन्दी", "ภาษาไทย", "Hello", "中文字", "e\u0301te\u0301", "a", "b", "привет́"]
    for c in range(0x2FA20):
        assert bool(_WORDS.search(chr(c))) == chr(c).isalpha()


def test_sample_never_reaches_zero(spark):
    assert [sampled_below(n, 5000) > 0 for n in (1, 10**6, 10**11, 10**20)] == [True] * 4
    assert abs(sampled_below(10**11, 5000) / SAMPLE_SPACE - 5e-8) < 1e-12
    docs = corpus(spark, 300).where("lang <> 'ru' OR doc_id < 20")  # a rare language keeps its rows
    assert fit_languages(docs, train_rows=30).langs == ["de", "en", "ru"]


def test_documents_stay_where_nothing_was_learnt(spark):
    docs = corpus(spark, 30).withColumn("lang", F.lit(None).cast("string")).unionByName(
        spark.createDataFrame([(90, "12 !", None), (91, None, None)], "doc_id long, text string, lang string"))
    assert keep_identified(docs, fit_languages(docs)).count() == 30
