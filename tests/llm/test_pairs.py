import random

import numpy as np
import pytest

from tracelake.llm import pairs as P
from tracelake.llm import refusals
from tracelake.llm.language import BUCKETS, _grams, fitted, prose

SENTENCES = {
    "en": ["The value of the chart rises from {n} to {n} over the whole period.", "Most of the items are placed under the second line of the page.", "After the first call the reader returned {n} points for this label."],
    "de": ["Der Wert der Grafik steigt von {n} auf {n} über den ganzen Zeitraum.", "Die meisten Einträge stehen unter der zweiten Zeile auf der Seite.", "Nach dem ersten Aufruf lieferte das Werkzeug {n} Punkte für das Feld."],
    "fr": ["La valeur du graphique passe de {n} à {n} sur toute la période.", "La plupart des éléments se trouvent sous la deuxième ligne de la page.", "Après le premier appel, le lecteur a rendu {n} points pour la case."],
    "es": ["El valor del gráfico sube de {n} a {n} durante todo el periodo.", "La mayoría de los elementos están debajo de la segunda línea de la página.", "Tras la primera llamada el lector devolvió {n} puntos para la casilla."],
    "zh": ["图表的数值在整个时期从{n}升到{n}。", "大多数项目位于页面的第二行下面。", "第一次调用之后，工具为该标签返回了{n}个点。"],
}
QUERY = {"en": "How many items are placed under the second line?", "de": "Wie viele Einträge stehen unter der zweiten Zeile?", "fr": "Combien d'éléments se trouvent sous la deuxième ligne ?", "es": "¿Cuántos elementos están debajo de la segunda línea?", "zh": "第二行下面有多少个项目？"}


def said(r, lang, n):
    return " ".join(r.choice(SENTENCES[lang]).replace("{n}", str(r.randint(2, 999)), 1).replace("{n}", str(r.randint(2, 999))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(1)
    return spark.createDataFrame([(said(r, lang, 4), lang.upper() if k % 7 == 0 else lang) for lang in SENTENCES for k in range(60)] + [(None, "en"), ("x", None), ("y", "und"), (said(r, "de", 4), "deu"), (said(r, "zh", 4), "zh-CN"), ("w", "english text")], "text string, lang string").cache()


@pytest.mark.parametrize(
    "answer, empty",
    [(None, True), ("", True), (" \n​﻿", True), ("```\n```", True), ("```html\n```", True), ("<p> </p>", True), ("\\boxed{}", True), ("**", True), ("&nbsp;", True), ("-", True), ("0", False), ("中", False), ("a", False), ("\\boxed{3}", False), ("👍", False)],
)
def test_empty(answer, empty):
    assert P.is_empty(answer) is empty


def test_copied():
    q = "What value does the red bar show in 2003?"
    for a in (q, q.upper(), f"> {q}", f"Question: {q}", f"{q}\n{q}", "What value does red bar show in 2003", f"**{q}**"):
        assert P.is_copied(q, a), a
    for a in (f"{q}\n14", f"{q} The red bar shows 5.", "The red bar shows 5.", "What value?", "2003"):
        assert not P.is_copied(q, a), a


#: Refusals in words that the grammar doesn't have as a whole, and answers that speak alike.
DECLINED = {
    "en": ["I'm sorry, but I can't help with this image.", "Unable to comply with this request.", "Sorry, no can do, ask elsewhere.", "I do not wish to respond to this query.", "I must respectfully turn you down.", "That's a question I will not be taking.", "I respectfully withhold an answer.", "Afraid I can't be of assistance with that.", "Let's not go there; I won't discuss it.", "No reply to this will be given.", "I can't provide what you ask for.", "Answering this is not something I am willing to do."],
    "de": ["Leider kann ich diese Frage nicht beantworten.", "Das werde ich nicht tun.", "Damit kann ich leider nicht dienen.", "Hierbei bin ich keine Hilfe.", "Dazu will ich keine Angaben machen.", "Darüber möchte ich nicht sprechen.", "Da kann ich nicht weiterhelfen.", "Ich werde mich hierzu nicht äußern.", "Ihre Bitte kann ich nicht erfüllen."],
    "fr": ["Je ne peux pas répondre à cette question.", "Je préfère ne pas aborder ce sujet.", "Cela ne m'est pas permis.", "Je ne donnerai pas suite à cette demande.", "Je ne répondrai pas à cela.", "Je ne suis pas habilité à en parler.", "Je me vois contraint de refuser.", "Désolé, cela m'est impossible."],
    "es": ["No puedo ayudar con eso.", "Lo siento, prefiero no entrar en ese tema.", "No estoy dispuesto a responder.", "Eso no lo puedo contestar.", "No me corresponde dar esa respuesta.", "No pienso contestar a eso.", "Me veo obligado a declinar la petición.", "No tengo autorización para hablar de ello."],
    "zh": ["抱歉，我无法回答这个问题。", "抱歉，我帮不了您。", "这个问题我不方便回答。", "我没法给出答案。", "很抱歉，该内容我不能提供。", "我不会回答您的问题。", "抱歉，恕难从命。", "这个请求我不能满足。"],
}
TOLD = ["The sign says that staff cannot help, and the code is Zeta.", "I was unable to open the first crop, but the second shows 12.", "I cannot see a second bar, so the count stays at 3.", "Sorry for the small crop; the label reads Alpha.", "No, it is smaller.", "The chart does not show this value.", "I will count the bars from left to right.", "Yes, I can see it.", "I am not sure, but it looks blue.", "Ich zähle vier Balken.", "Je vois trois barres.", "Veo tres barras rojas.", "我看到三个红色的条形。", "42", "", "I cannot help with that, but the answer is 12."]


@pytest.fixture(scope="module")
def ratio(spark):
    r = random.Random(4)
    return refusals.fitted(*(spark.createDataFrame([(said(r, lang, 3),) for lang in SENTENCES for _ in range(40)] + [(None,)], "t string") for _ in range(2)))


@pytest.mark.parametrize("lang", list(DECLINED))
def test_refusals_in_held_out_words(ratio, lang):
    held = [x for x in DECLINED[lang] if x not in refusals.composed()[0]]
    assert len(held) >= 0.7 * len(DECLINED[lang])
    assert sum(ratio.declining(held)) >= 0.9 * len(held)
    assert ratio.declining([held[0] + " It is not for me to say. " * 100])[0]


def test_no_refusal(ratio):
    r = random.Random(5)
    assert not any(ratio.declining(TOLD))
    assert sum(ratio.declining([said(r, lang, 2).replace("0", "some") for lang in SENTENCES for _ in range(100)])) == 0


def test_language_of_held_out_texts(spark, labelled):
    r, model = random.Random(99), fitted(labelled)
    assert model.languages == ["de", "en", "es", "fr", "zh"]
    for a in SENTENCES:
        for b in SENTENCES:
            for _ in range(5):
                assert P.wrong_language(model, QUERY[a], said(r, b, 1)) is (a != b)
    en = QUERY["en"]
    assert not P.wrong_language(model, en + " Answer in German.", said(r, "de", 1))
    assert P.wrong_language(model, en + " Reply in French, please.", said(r, "en", 1))
    for same in (f'The sign says "{said(r, "de", 1)}" and nothing else is there.', "Zalmobar", "- Zalmobar: 3\n- Grivagate: 5", "`der die das und ist`", "12", ""):
        assert not P.wrong_language(model, en, same), same
    assert prose("see /mnt/data/x.png") == ""
    assert not P.wrong_language(fitted(labelled.limit(0)), en, said(r, "de", 1))


def test_first_defect_of_each_pair(spark, labelled):
    r = random.Random(3)
    rows, expect = [], {}

    def add(query, answer, defect):
        rows.append(("t", f"r{len(rows)}", len(rows) % 3, query, answer, 1))
        if defect:
            expect[rows[-1][1]] = defect

    for k in range(400):
        lang = r.choice(list(SENTENCES))
        text = said(r, lang, r.randint(1, 4))
        add(QUERY[lang], r.choice(["", "<think>all der die das</think>"]) + text, None)
        if k % 8 == 0:
            cut = text[: -r.randint(2, 10)]  # anywhere, as an end that is cut again and again looks like one
            add(QUERY[lang], cut, "truncated")
        if k % 20 == 0:
            add(QUERY[lang], "<think>" + text, "truncated")
            add(None, '{"a": [1, 2', "truncated")
    add(None, None, "empty")
    add("", "", "empty")
    add(QUERY["en"], QUERY["en"], "copied_question")
    add(None, said(r, "de", 2), None)
    add(QUERY["en"], said(r, "de", 2), "wrong_language")
    add(QUERY["de"], "I'm sorry, I cannot answer that.", "refusal")
    add(QUERY["en"], "word " * 60_000 + "end.", None)
    df = spark.createDataFrame(rows, "source_table string, record_id string, sample_index int, query string, answer string, defect int")
    got = {x.record_id: x.defect for x in P.defects(df, labelled).collect()}
    assert {k: v for k, v in got.items() if v != "truncated"} == {k: v for k, v in expect.items() if v != "truncated"}
    found = {k for k, v in got.items() if v == "truncated"}
    true = {k for k, v in expect.items() if v == "truncated"}
    assert len(found & true) >= 0.95 * len(true) and len(found - true) <= 0.02 * len(found)


def test_empty_table(spark, labelled):
    df = spark.createDataFrame([], "source_table string, record_id string, sample_index int, query string, answer string")
    assert P.defects(df, labelled).count() == 0


def test_size_and_markup_hide_no_defect(spark, labelled):
    q = "What value does the red bar show in 2003?"
    assert P.is_copied(q, " ".join([q] * 200)) and P.is_copied(q, " ".join([q] * 60 + [q.replace("red ", "")] + [q] * 60)) and P.is_copied(q, f"Question: {q} {q}")
    assert not P.is_copied(q, " ".join([q] * 200) + " 14") and not P.is_copied(q, " ".join([q] * 60 + ["It shows 14 points there."] * 60))
    r, model = random.Random(5), fitted(labelled)
    page, own = (f"<html><body><p>{said(r, lang, 3)}</p></body></html>" for lang in ("de", "en"))
    assert P.wrong_language(model, QUERY["en"], page) and not P.wrong_language(model, QUERY["en"], own)
    assert P.wrong_language(model, QUERY["en"], "```python\nx = 1\n```\n" + said(r, "fr", 3))
    assert not P.wrong_language(model, QUERY["en"], '{"a": "' + said(r, "de", 2) + '"}')


def test_laws_count_all_rows(spark, monkeypatch):
    """Bounds say what the counts weigh, not which rows are counted."""
    r = random.Random(8)
    said_ = {lang: [said(r, lang, 2) for _ in range(90)] for lang in ("de", "en")}
    df = spark.createDataFrame([(t, lang) for lang, ts in said_.items() for t in ts], "text string, lang string")
    model = fitted(df, labelled=30)
    counts = np.stack([np.bincount(np.concatenate([_grams(prose(t, False)) for t in said_[x]]), minlength=BUCKETS) for x in model.languages], axis=1) / 3 + 0.5
    assert np.allclose(model.logs, np.log(counts / counts.sum(axis=0)))
    monkeypatch.setattr(refusals, "TEXTS", 30)
    monkeypatch.setattr(refusals, "ANSWERS", 45)
    parts = [[s for t in said_[x] for s in refusals.sentences(t)] for x in ("de", "en")]
    expect = refusals.Ratio(refusals.counted(parts[0]) / 3 + refusals.counted(parts[1]) / 2, len(parts[0]) / 3 + len(parts[1]) / 2)
    found = refusals.fitted(*(spark.createDataFrame([(t,) for t in said_[x]], "t string") for x in ("de", "en")))
    assert np.allclose(found.logs, expect.logs)
    assert refusals.sentences("It is 3.14 here. So.\nNo 5") == ["14 here.", "So.", "No 5"]
