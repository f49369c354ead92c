from pyspark.sql import functions as F

from plumbline.llm import language_id

WORDS = {
    "en": "the and of that with this have from they would there their which about people into other could time",
    "de": "der und die nicht auch wird eine sich über werden können schon zwischen möchte größer weiß heißen",
    "fr": "les des pour dans une avec être été où déjà français même très après ça nous vous leur aussi",
    "es": "los las para una pero más también está años señor mañana qué cuando donde porque niño todavía",
}


def corpus(n=160):
    import random

    rng = random.Random(2)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(8, 60))), lang))
    return rows


def test_accuracy_and_edges(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("held", language_id.held_out())
    model = language_id.train(docs.where("not held"))
    assert model.languages == ["de", "en", "es", "fr"] and len(model.machines) == 3
    asked = docs.where("held").select("doc_id", "text").unionByName(spark.createDataFrame([(900, None), (901, ""), (902, "12 -- 3"), (903, "x"), (904, "über " * 40000), (905, "語")], "doc_id long, text string"))
    got = {r.doc_id: r for r in language_id.predict(asked, model).collect()}
    truth = {d: lang for d, _, lang in rows}
    held = [d for d in got if d < 900]
    assert sum(got[d].lang_pred == truth[d] for d in held) >= 0.97 * len(held)
    assert [got[d].lang_pred for d in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert got[903].lang_pred in truth.values() and got[904].lang_pred == "de" and got[905].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_slices_do_not_matter(spark, monkeypatch):
    rows = corpus(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    one = sorted(map(tuple, language_id.predict(docs.coalesce(1), model).select("doc_id", "lang_pred", F.round("score", 5)).collect()))
    many = sorted(map(tuple, language_id.predict(docs.repartition(7), model).select("doc_id", "lang_pred", F.round("score", 5)).collect()))
    assert one == many


def test_few_languages(spark):
    docs = spark.createDataFrame([(1, "abc", "en"), (2, "def", "en"), (3, "??", None)], "doc_id long, text string, lang string")
    assert sorted(map(tuple, language_id.predict(docs, language_id.train(docs)).select("doc_id", "lang_pred").collect())) == [(1, "en"), (2, "en"), (3, "und")]
    none = language_id.train(docs.where("lang is null"))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), none).count() == 0


def test_learns_from_whole_texts(spark):
    # All texts open alike; what tells them apart comes later.
    rows = [(d, "1 of 2 notes " * 400 + t, lang) for d, t, lang in corpus(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = corpus(160)[80:]
    got = {r.doc_id: r.lang_pred for r in language_id.predict(spark.createDataFrame(asked, "doc_id long, text string, lang string").select("doc_id", "text"), language_id.train(docs)).collect()}
    assert sum(got[d] == lang for d, _, lang in asked) >= 0.9 * len(asked)


def test_counts_of_pieces(spark, monkeypatch):
    import numpy as np

    text = "über alles, the one " * 40
    for size in (7, 1 << 18):
        monkeypatch.setattr(language_id, "SLICE_BYTES", size)
        (r,) = language_id.counted(spark.createDataFrame([(1, text)], "pick long, text string")).collect()
        at, n = np.unique(language_id.trigrams(np.frombuffer((text + "  ").encode(), dtype=np.uint8)), return_counts=True)
        assert np.frombuffer(r.at, dtype=np.uint16).tolist() == at.tolist() and np.frombuffer(r.n, dtype=np.int64).tolist() == n.tolist()


def test_letters_are_of_category_l():
    assert not any(language_id.has_letter(t) for t in ("", "12 ½ ² ① Ⅷ _ -", "\u0301"))
    assert all(language_id.has_letter(t) for t in ("a", "1é", "語", "ª", "ʰ"))


def test_votes_equal_a_plain_loop():
    import numpy as np

    m = language_id.Model(["de", "en", "es", "fr", "fi", "nl"])
    margins = np.round(np.random.default_rng(3).normal(size=(300, len(m.machines))), 1).astype(np.float32)
    index, score = m.decide(margins)

    def plain(row, members, of):
        won = {x: [0, 0.0, 1.0] for x in members}
        for k, (a, b) in enumerate(m.machines):
            if of(a) not in won or of(b) not in won or of(a) == of(b) or (of is not family) != (len(a) == len(b) == 1 and family(a) == family(b)):
                continue
            x, y = (of(a), of(b)) if row[k] >= 0 else (of(b), of(a))
            won[x][0] += 1
            won[x][2] = min(won[x][2], 1 / (1 + np.exp(-4.0 * abs(float(row[k])))))
            won[of(a)][1] += row[k]
            won[of(b)][1] -= row[k]
        best = max(members, key=lambda x: (won[x][0], won[x][1]))
        return best, won[best][2]

    family = lambda langs: language_id.FAMILY_OF[langs[0]]
    for row, i, s in zip(margins, index, score):
        g, sure = plain(row, sorted(m.groups), family)
        lang, within = plain(row, m.groups[g], lambda langs: langs[0])
        assert m.languages[i] == lang and abs(s - min(sure, within)) < 1e-6


def test_null_ids_and_clashing_columns(spark):
    rows = [(None if d % 7 == 0 else d, t, lang, 1.5) for d, t, lang in corpus(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = language_id.predict(docs, language_id.train(docs)).collect()
    assert len(got) == len(rows) and sum(r.doc_id is None for r in got) == sum(r[0] is None for r in rows)
    assert all(0 <= r.score <= 1 for r in got)
