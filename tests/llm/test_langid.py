import random

import pytest
from pyspark.sql import functions as F

from tessellar.llm import langid as G

BASE = {
    "en": "the river was cold and nobody in this village had ever seen such a bright morning before they went home with their sheep",
    "de": "der fluss war kalt und niemand in diesem dorf hatte jemals einen so hellen morgen gesehen bevor sie mit ihren schafen nach hause gingen",
    "fr": "la rivière était froide et personne dans ce village n'avait jamais vu un matin aussi clair avant de rentrer avec leurs moutons",
    "es": "el río estaba frío y nadie en este pueblo había visto nunca una mañana tan clara antes de volver a casa con sus ovejas",
    "pt": "o rio estava frio e ninguém nesta aldeia tinha visto uma manhã tão clara antes de voltarem para casa com as suas ovelhas",
    "nl": "de rivier was koud en niemand in dit dorp had ooit zo een heldere ochtend gezien voordat zij met hun schapen naar huis gingen",
    "it": "il fiume era freddo e nessuno in questo paese aveva mai visto una mattina così chiara prima di tornare a casa con le pecore",
}


@pytest.fixture(scope="module")
def labeller():
    rng = random.Random(1)
    texts = []
    for lang, t in BASE.items():
        ws = t.split()
        for _ in range(30):
            texts.append((lang, " ".join(rng.sample(ws, len(ws)))))
        texts.append((lang, BASE["en"]))  # a wrong label
    return G.Labeller(G.fit(texts))


def langs(labeller, text):
    return [(x[0], x[1], x[2]) for x in labeller.stretches([text])[0]]


@pytest.mark.parametrize("lang", G.LANGS)
def test_single_language(labeller, lang):
    t = BASE[lang]
    for form in (t, t.upper(), t.replace(" ", "   "), G.unicodedata.normalize("NFD", t)):
        got = langs(labeller, form)
        assert [x[0] for x in got] == [lang] and got[0][1:] == (0, len(form.split()))


def test_mixed_and_short_phrases(labeller):
    t = f"{BASE['de']} {BASE['fr']} \f {BASE['de']}"
    assert [x[0] for x in langs(labeller, t)] == ["de", "fr", "de"]
    quote = " ".join(BASE["es"].split()[:6])
    assert [x[0] for x in langs(labeller, f"{BASE['en']} \"{quote}\" {BASE['en']}")] == ["en"]
    assert [x[0] for x in langs(labeller, f"{BASE['en']} {quote} 320 0 obj << /L 4494 >> 44d8a625")] == ["en"]


def test_no_language_short_empty_null_scripts(labeller):
    dump = "237.782 633.046 2.33 re f 0 0 17 39 cm 69 34 06 BB 0F D8 0000 f\n" * 3
    assert [x[0] for x in langs(labeller, dump)] == ["zxx"]
    assert langs(labeller, "the cold river") == [] and langs(labeller, "") == [] and labeller.stretches([None]) == [[]]
    assert [x[0] for x in langs(labeller, "река была холодной и никто в этой деревне никогда не видел такого светлого утра раньше")] == ["ru"]
    assert all(0 < x[3] <= 1 for x in labeller.stretches([BASE["en"], dump])[0])


def test_very_long_text(labeller):
    t = " ".join([BASE["en"]] * 3000 + [BASE["it"]] * 2000)
    assert [x[0] for x in langs(labeller, t)] == ["en", "it"]


@pytest.mark.parametrize("raw,want", [("en_US", "en"), ("EN", "en"), ("German", "de"), ("fre", "fr"), ("pt-BR", "pt"), ("dut", "nl"), ("", None), (" ", None), ("??", None), (None, None), ("n/a", None), ("und", None), ("xx", None), ("zxx", "zxx"), ("ru", "ru")])
def test_labels(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "v string").select(G.label_language(F.col("v")).alias("x")).first().x == want


def docs(spark, rows):
    return spark.createDataFrame([(*r, "c", 5) for r in rows], "doc_id bigint, text string, lang string, label string, seg_no int")


def test_faults_end_to_end(spark):
    rng = random.Random(2)
    rows = []
    for i in range(140):
        lang = G.LANGS[i % 7]
        ws = BASE[lang].split()
        rows.append((i, " ".join(rng.sample(ws, len(ws))), lang))
    rows += [(200, BASE["fr"], "en"), (201, BASE["it"], None), (202, f"{BASE['nl']} {BASE['en']}", "nl"), (203, None, "en"), (204, "", None), (205, "too short", None), (None, BASE["en"], None), (206, BASE["de"], "Deutsch"), (200, BASE["fr"], "en")]
    s = G.language_stretches(docs(spark, rows))
    got = sorted((r.doc_id, r.seg_no, r.lang) for r in G.label_faults(s).collect())
    assert got == [(200, 1, "fr"), (200, 1, "fr"), (201, 1, "it"), (202, 1, "nl"), (202, 2, "en")]


def test_sample_is_bounded_and_stable(spark):
    d = docs(spark, [(i, BASE["en"] + f" {i}", "en" if i % 3 else "de") for i in range(900)])
    a, b = G.sample(d, 50), G.sample(d.repartition(7), 50)
    assert a == b and len(a) == 100


def test_empty_table_and_no_labels(spark):
    assert G.language_stretches(docs(spark, [])).count() == 0
    r = G.language_stretches(docs(spark, [(1, BASE["en"] + " and it is the one that was for this", None)])).collect()
    assert [x.lang for x in r] == ["en"]


def test_short_texts_and_whole_documents(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.sample(BASE[lang].split(), 18)), lang) for i in range(140) for lang in [G.LANGS[i % 7]]]
    rows += [(200, "der fluss war kalt", None), (201, "0000 65535 f", "en"), (202, f"{BASE['nl']} {BASE['en']} {BASE['nl']}", None), (203, None, "en"), (204, " ", None), (205, BASE["it"], "it")]
    d = docs(spark, rows)
    s = G.language_stretches(d)
    got = {r.doc_id: r for r in s.where("doc_id IN (200, 201)").collect()}
    assert {k: (r.seg_no, r.lang, r.n_words, r.n_segs) for k, r in got.items()} == {200: (1, "de", 4, 1), 201: (1, "zxx", 3, 1)}
    assert all(0 < r.confidence < 1 for r in got.values())
    assert {r.doc_id for r in G.label_faults(s).collect()} == {202}
    whole = {r.doc_id: r for r in G.document_languages(s, d).collect()}
    assert set(whole) == {r[0] for r in rows} and {k: (whole[k].lang, whole[k].n_segs) for k in range(200, 206)} == {200: ("de", 1), 201: ("zxx", 1), 202: ("nl", 3), 203: ("zxx", 0), 204: ("zxx", 0), 205: ("it", 1)}
    assert 0.4 < whole[202].confidence < 0.7 < whole[205].confidence <= 1


def rows_of(spark, texts):
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    return df.coalesce(1)


def test_batches_without_language_or_words(spark, labeller):
    assert G.language_stretches(rows_of(spark, ["", "  \n", None]), labeller.model).collect() == []
    got = G.language_stretches(rows_of(spark, ["too short", "", "ok"]), labeller.model).collect()
    assert sorted((r.doc_id, r.n_words, r.n_segs) for r in got) == [(0, 2, 1), (2, 1, 1)] and G.label_faults(G.language_stretches(rows_of(spark, ["too short"]), labeller.model)).count() == 0


def test_texts_without_blanks(spark, labeller):
    texts = ["河水很冷村里没有人见过这样明亮的早晨" * 40, "川は冷たくこの村の誰もこんなに明るい朝を見たことがなかった" * 40, "แม่น้ำเย็นและไม่มีใครในหมู่บ้านนี้เคยเห็นเช้าที่สดใสเช่นนี้" * 40]
    got = {r.doc_id: r.lang for r in G.language_stretches(rows_of(spark, texts), labeller.model).collect()}
    assert got == {0: "zh", 1: "ja", 2: "th"}


def test_sentences_inside_a_long_dump(labeller):
    dump = "237.782 633.046 2.33 re f 0 0 17 39 cm 69 34 06 BB 0F D8 0000 f\n" * 150
    text = dump + BASE["fr"] + " " + BASE["fr"] + " " + BASE["fr"] + "\n" + dump
    assert [x[0] for x in langs(labeller, text)] == ["fr"] and [x[0] for x in langs(labeller, dump)] == ["zxx"]
