"""Answers that decline, by a likelihood ratio of character n-grams.

Two laws over hashed n-grams are compared sentence by sentence: one of declining sentences, fitted on sentences that a small
grammar of openers, ways to decline and things declined composes for each language (at most ``COMPOSED`` a language, chosen
by a fixed seed), and one of all other sentences, fitted on sentences that say other things in the same forms and on those of all texts and answers at
hand. The law mixes these: the texts weigh as much as ``TEXTS`` of them at most, the answers as ``ANSWERS``. A sentence declines if a stretch of it sums up to more than ``BOUND``; an answer is a refusal if a sentence declines and the
others give no value.
"""

from __future__ import annotations

import itertools
import random
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.language import COUNTERS, counters, summed

COMPOSED, TEXTS, ANSWERS, BITS = 1500, 500, 4000, 18
SHORTEST, LONGEST, SMOOTHING, CLIP, BIAS, BOUND = 3, 7, 0.5, 4.0, 0.5, 6.0

#: Parts of declining sentences, by language: openers, ways to decline, things declined, ends, and whole sentences.
GRAMMAR: dict[str, tuple[list[str], list[str], list[str], list[str], list[str]]] = {
    "en": (
        ["", "", "Sorry, ", "Sorry, but ", "I'm sorry, but ", "I apologize, but ", "I am afraid ", "Unfortunately, ", "As an AI model, ", "As an AI assistant, ", "Apologies, but ", "Thanks for asking, but ", "No, ", "With regret, "],
        ["I can't ", "I cannot ", "I can not ", "I could not ", "I won't ", "I will not ", "I am unable to ", "I'm unable to ", "I am not able to ", "I'm not able to ", "I am not allowed to ", "I'm not permitted to ", "I must decline to ", "I have to decline to ", "I decline to ", "I refuse to ", "I must refuse to ", "I'd rather not ", "I would rather not ", "I prefer not to ", "I'd prefer not to ", "I do not want to ", "I don't feel comfortable enough to ", "I choose not to ", "I am not going to ", "I'm not willing to ", "I'm not in a position to ", "it is not possible for me to ", "it's impossible for me to ", "we are unable to ", "we cannot ", "my guidelines do not allow me to ", "my policy prevents me from being able to ", "unable to ", "I have no permission to ", "I lack the ability to ", "I have no way to ", "I shall not ", "I may not ", "I have to refrain from trying to "],
        ["help with that", "help with this image", "help you with this", "assist with this request", "assist you here", "answer that", "answer this question", "answer this one", "respond to this", "reply to that", "comply with this request", "comply", "discuss this topic", "discuss that", "comment on this", "comment on that image", "provide that information", "provide this", "give an answer", "give that out", "share that", "share this information", "do that", "do this", "fulfill this request", "process this request", "continue with this", "engage with this topic", "go into that topic", "handle this", "view this image", "look at this picture", "say", "talk about that", "take on this task", "reveal that", "support this request", "read this chart for you", "work on this"],
        [".", ".", ".", " at this time.", " for you.", ", sorry.", " because of my guidelines.", " here.", "!"],
        ["That is against my guidelines.", "This goes against my rules.", "No comment.", "I must decline.", "I have to decline this request.", "I decline.", "I refuse.", "I'll pass on this one.", "I'd rather leave this unanswered.", "I prefer to stay silent on this.", "Sorry, that is not something I can do.", "That's outside what I can do.", "This is beyond what I am allowed to do.", "This request falls outside my guidelines.", "My instructions forbid answering this.", "No answer can be given by me.", "You will get no answer from me.", "I will have to turn this down.", "My apologies, this one I have to turn down.", "Request declined.", "Request refused.", "No can do.", "Not able to help.", "Cannot comply.", "I'm going to skip this one.", "It would not be appropriate for me to answer.", "Please ask someone else.", "You should ask somebody else about this.", "That is something I do not do."],
    ),
    "de": (
        ["", "", "Leider ", "Tut mir leid, aber ", "Es tut mir leid, ", "Entschuldigung, ", "Bedaure, ", "Als KI-Modell ", "Nein, ", "Ich bedauere, aber "],
        ["kann ich dazu nicht ", "ich kann das nicht ", "ich kann diese Frage nicht ", "ich kann dir dabei nicht ", "ich darf das nicht ", "darf ich diese Anfrage nicht ", "ich möchte das nicht ", "ich möchte diese Frage nicht ", "ich werde das nicht ", "werde ich diese Bitte nicht ", "das werde ich nicht ", "das kann ich nicht ", "das darf ich nicht ", "das möchte ich nicht ", "ich will das lieber nicht ", "es ist mir nicht möglich, das zu ", "es ist mir nicht erlaubt, diese Frage zu ", "ich bin nicht in der Lage, das zu ", "ich bin nicht befugt, das zu ", "ich kann Ihnen hierbei nicht ", "wir können diese Anfrage nicht ", "ich weigere mich, das zu "],
        ["beantworten", "helfen", "weiterhelfen", "tun", "machen", "sagen", "bearbeiten", "erfüllen", "kommentieren", "besprechen", "unterstützen", "angeben", "ansehen", "preisgeben", "behandeln", "ausführen", "übernehmen", "antworten"],
        [".", ".", ".", ", tut mir leid.", "!", " und bitte um Verständnis."],
        ["Ich muss diese Anfrage ablehnen.", "Ich lehne das ab.", "Ich muss leider ablehnen.", "Das verstößt gegen meine Richtlinien.", "Das widerspricht meinen Vorgaben.", "Dazu sage ich nichts.", "Kein Kommentar.", "Darauf gebe ich keine Antwort.", "Hierzu kann ich keine Auskunft geben.", "Dazu möchte ich mich nicht äußern.", "Ich verweigere die Antwort.", "Dabei kann ich nicht behilflich sein.", "Ich passe bei dieser Frage.", "Lieber äußere ich mich dazu nicht.", "Diese Bitte muss ich zurückweisen.", "Meine Regeln lassen das nicht zu.", "Bitte fragen Sie jemand anderen.", "Das liegt außerhalb dessen, was ich tun darf.", "Anfrage abgelehnt."],
    ),
    "fr": (
        ["", "", "Désolé, ", "Désolé, mais ", "Je suis désolé, mais ", "Malheureusement, ", "Je regrette, ", "En tant que modèle d'IA, ", "Non, ", "Excusez-moi, mais "],
        ["je ne peux pas ", "je ne peux ni ne veux ", "je ne suis pas en mesure de ", "je ne suis pas autorisé à ", "je ne souhaite pas ", "je ne veux pas ", "je ne vais pas ", "je ne saurais ", "je refuse de ", "je dois refuser de ", "je préfère ne pas ", "je suis incapable de ", "il m'est impossible de ", "il ne m'est pas possible de ", "il ne m'est pas permis de ", "je n'ai pas le droit de ", "nous ne pouvons pas ", "je m'abstiens de ", "impossible de "],
        ["répondre à cette question", "répondre à cela", "répondre", "vous aider avec cela", "vous aider", "aider avec cette image", "traiter cette demande", "donner cette information", "fournir de réponse", "commenter ce sujet", "discuter de cela", "faire cela", "le faire", "satisfaire cette demande", "accéder à cette demande", "en parler", "en dire plus", "examiner cette image", "m'exprimer sur ce point"],
        [".", ".", ".", ", désolé.", " pour vous.", " ici."],
        ["Je dois décliner cette demande.", "Je décline.", "Je refuse.", "C'est contraire à mes règles.", "Cela va à l'encontre de mes consignes.", "Sans commentaire.", "Pas de réponse de ma part.", "Cette demande dépasse ce que je peux faire.", "Mes consignes ne me le permettent pas.", "Je passe mon tour sur cette question.", "Demande refusée.", "Je préfère m'abstenir.", "Veuillez demander à quelqu'un d'autre.", "Je ne ferai pas cela."],
    ),
    "es": (
        ["", "", "Lo siento, ", "Lo siento, pero ", "Lamentablemente, ", "Disculpa, pero ", "Perdón, ", "Como modelo de IA, ", "No, ", "Me temo que "],
        ["no puedo ", "no podré ", "no puedo ni debo ", "no me es posible ", "no me está permitido ", "no estoy autorizado a ", "no estoy en condiciones de ", "no quiero ", "no deseo ", "no voy a ", "me niego a ", "debo negarme a ", "prefiero no ", "tengo que rechazar ", "me es imposible ", "no soy capaz de ", "no tengo permiso para ", "no tengo forma de ", "no podemos ", "debo abstenerme de ", "imposible "],
        ["ayudar con eso", "ayudarte con esto", "ayudarle", "responder a esta pregunta", "responder a eso", "responder", "contestar", "contestar esta pregunta", "atender esta solicitud", "dar esa información", "proporcionar una respuesta", "comentar este tema", "hablar de eso", "entrar en este asunto", "hacer eso", "hacerlo", "cumplir con esta petición", "ver esta imagen", "opinar sobre ello", "tratar ese asunto", "decirlo"],
        [".", ".", ".", ", lo siento.", " aquí.", " en este momento."],
        ["Debo rechazar esta solicitud.", "Rechazo esta petición.", "Tengo que declinar.", "Eso va en contra de mis normas.", "Mis directrices no me lo permiten.", "Sin comentarios.", "De mi parte no habrá respuesta.", "Esto queda fuera de lo que puedo hacer.", "Solicitud rechazada.", "Paso de esta pregunta.", "Prefiero guardar silencio.", "Pregunte a otra persona, por favor.", "No lo haré."],
    ),
    "zh": (
        ["", "", "抱歉，", "对不起，", "很抱歉，", "很遗憾，", "作为AI模型，", "不好意思，", "不，"],
        ["我无法", "我不能", "我不可以", "我没办法", "我没有办法", "我不便", "我不会", "我不愿", "我不愿意", "我不想", "我拒绝", "我必须拒绝", "我只能拒绝", "恕我无法", "恕不能", "无法", "我没有权限", "我不被允许", "我无权", "请原谅我不能"],
        ["回答这个问题", "回答", "帮助您", "帮您完成", "帮忙处理这件事", "协助您", "协助这个请求", "处理这个请求", "提供这些信息", "提供答案", "讨论这个话题", "评论这张图片", "谈论此事", "完成这个任务", "满足这个要求", "透露这些内容", "查看这张图片", "继续", "这样做", "对此作答"],
        ["。", "。", "。", "，请谅解。", "！"],
        ["这违反了我的准则。", "这超出了我的能力范围。", "无可奉告。", "我选择不作答。", "此请求已被拒绝。", "我的规定不允许这样做。", "请询问其他人。", "对此我不予置评。", "这件事我做不到。", "我只能婉拒。"],
    ),
}

#: Parts of sentences that speak in the same way and decline nothing: openers, ways to tell, things told.
TELLING: list[tuple[list[str], list[str], list[str]]] = [
    (
        ["", "", "Yes, ", "No, ", "Well, ", "Sorry for the small crop; ", "Unfortunately the crop is small, but ", "Here ", "Question: ", "Your question was: ", "Thank you for the picture. ", "In this image, "],
        ["I can see ", "I see ", "I can read ", "I am not sure, but it is ", "I'm not certain, but I think it shows ", "I think it is ", "I will count ", "I'll look at ", "I would say ", "I cannot see a second one, so it is ", "I can't find another, so it stays at ", "I could not find anything smaller than ", "I did not find ", "I do not see ", "I don't think it is ", "I was unable to open the first crop, but the second one shows ", "I was not able to read the first label, but the next one is ", "it does not show ", "it is not ", "it isn't ", "there is no ", "the tool could not read ", "the file cannot be opened without ", "the sign says that staff cannot help with ", "the text says no comment on ", "the label reads ", "the answer is ", "how many items stand at ", "what value does it show for ", "you can see ", "we can see ", "we have to add ", "I have to add ", "I must subtract ", "I had to rotate ", "I need to look at ", "I prefer the reading of ", "I refer to ", "I provide "],
        ["the red bar", "blue", "three items", "a larger value", "the second column", "the same as before", "the left one", "the legend", "the total", "this chart", "the picture", "the label in the corner", "that part of the image", "two of them", "the first answer", "a smaller box", "the question mark", "the help button", "this request form", "the bars from left to right", "what stands on the right", "the rest of the left side", "it all at once", "some more of this", "all that is left of the line"],
    ),
    (
        ["", "", "Ja, ", "Nein, ", "Ja, das stimmt: ", "Leider ist das Bild klein, aber ", "Hier "],
        ["ich sehe ", "ich kann dort ", "ich zähle ", "ich lese ", "ich bin nicht sicher, aber es ist ", "ich kann kein zweites sehen, also ist es ", "das ist nicht ", "es zeigt ", "es gibt keine ", "der Wert ist ", "ich muss noch addieren: ", "die Datei kann nicht geöffnet werden ohne ", "ich werde ablesen "],
        ["den roten Balken", "blau", "drei Einträge", "einen größeren Wert", "die zweite Spalte", "die Legende", "das Bild", "die linke Seite", "die Antwort oben", "das Hilfefeld"],
    ),
    (
        ["", "", "Oui, ", "Non, ", "Ici, "],
        ["je vois ", "je peux lire ", "je compte ", "je ne suis pas sûr, mais c'est ", "je ne vois pas d'autre élément, donc c'est ", "ce n'est pas ", "il n'y a pas ", "la valeur est ", "on ne peut pas ouvrir ", "je dois ajouter ", "la réponse est "],
        ["la barre rouge", "bleu", "trois éléments", "une valeur plus grande", "la deuxième colonne", "la légende", "l'image", "la case claire", "la question du haut"],
    ),
    (
        ["", "", "Sí, ", "No, ", "Aquí "],
        ["veo ", "puedo leer ", "cuento ", "no estoy seguro, pero es ", "no veo otro, así que es ", "no es ", "no hay ", "el valor es ", "no se puede abrir ", "tengo que sumar ", "la respuesta es "],
        ["la barra roja", "azul", "tres elementos", "un valor mayor", "la segunda columna", "la leyenda", "la imagen", "la casilla oscura", "la pregunta de arriba"],
    ),
    (
        ["", "", "是的，", "不，", "这里"],
        ["我看到", "我可以看到", "我数了", "我不确定，但应该是", "我没有看到第二个，所以是", "这不是", "没有", "数值是", "无法打开第一张图，但第二张显示", "答案是", "我需要加上"],
        ["红色的条形", "蓝色", "三个项目", "更大的数值", "第二列", "图例", "图片", "左边的那个", "上面的问题"],
    ),
]

#: A sentence, or what goes up to a mark inside a number and is left out.
_SENTENCE = re.compile(r"([^.!?。！？\n]*+(?:[.!?。！？](?!\d)[\"'”’»)\]*]*|\n|\Z))|[^.!?。！？\n]*+[.!?。！？]")
_VALUE = re.compile(r"\d|\\boxed|\*\*\s*\w")
_MARKUP = re.compile(r"<[^<>\n]*>|```\w*|https?:\S+|\S*[/\\_]\S*")
_MARKS = re.compile(r"[^\w\s',，]+|_")
_WIDE = re.compile(r"([一-鿿])")
_NAMES = re.compile(r"(?<=[\w,] )[A-ZÀ-Þ][a-zà-ÿ]{3,}(?=\W|$)")
_DIGITS = re.compile(r"\d[\d.,%]*")
_CLAUSE = re.compile(r"[,;:，；：](?!\d)")
_BLANKS = re.compile(r"[^\S\n]+")
_GIVEN = re.compile(r"\\boxed|\*\*[^*]+\*\*\s*\Z")


def sentences(text: str) -> list[str]:
    """Sentences and lines of a text."""
    return [s for s in (x.strip() for x in _SENTENCE.findall(text)) if s]


def composed(most: int = COMPOSED) -> tuple[list[str], list[str]]:
    """Declining and other sentences of the grammars: the whole ones, and compositions chosen by a fixed seed."""
    r, out, others = random.Random(11), [], []
    for openers, ways, things, ends, whole in GRAMMAR.values():
        every = [o + w + t + e for o, w, t, e in itertools.product(openers, ways, things, ends)]
        out += r.sample(every, min(most, len(every)))
        # whole sentences stand for a third of a language's
        out += r.choices([o + w for w in whole for o in openers], k=most // 2)
    for openers, ways, things in TELLING:
        every = [o + w + t for o, w, t in itertools.product(openers, ways, things)]
        others += r.choices(every, k=most)
    return out, others


def _read(lines: list[str]) -> str:
    """Sentences, a line each, in lower case without markup, digits and names inside a sentence; a character that is a word counts twice."""
    text = unicodedata.normalize("NFKC", _MARKUP.sub(" ", "\n".join(lines))).replace("’", "'")
    text = _DIGITS.sub("0", _NAMES.sub("N", text)).lower()
    return _WIDE.sub("\\1\x02", _BLANKS.sub(" ", _MARKS.sub(" ", text)))


class _Places:
    """The n-grams of SHORTEST to LONGEST characters at each place of sentences, none over two of them."""

    def __init__(self, read: str):
        text = " " + read.replace("\n", " \n ") + " "
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        edge = np.flatnonzero(codes == 10)
        self.line = np.cumsum(codes == 10)
        self.left = np.append(edge, len(codes))[self.line] - np.arange(len(codes))  # characters up to the end of the sentence
        self.grams, total = [], codes
        for k in range(1, LONGEST):
            total = (total[:-1] * np.uint64(0x100000001B3)) ^ codes[k:]
            if k + 1 >= SHORTEST:
                mixed = (total + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
                inside = self.left[: len(total)] > k
                self.grams.append(np.where(inside, (mixed ^ (mixed >> np.uint64(29))) >> np.uint64(64 - BITS), np.uint64(1 << BITS)).astype(np.int64))


def counted(lines: list[str], times: list[int] | None = None) -> np.ndarray:
    """In how many of the sentences each bucket occurs, a sentence counting as often as ``times`` says."""
    out = np.zeros((1 << BITS) + 1, np.int64)
    alike: dict[str, int] = {}  # sentences that read alike are taken once
    for k in range(0, len(lines), 5000):
        for line, n in zip(_read(lines[k : k + 5000]).split("\n"), times[k : k + 5000] if times else itertools.repeat(1)):
            alike[line] = alike.get(line, 0) + n
    read, weights = list(alike), np.array(list(alike.values()), np.float64)
    for k in range(0, len(read), 5000):
        at = _Places("\n".join(["", *read[k : k + 5000]]))  # behind an empty one, so that each has the same n-grams wherever it stands
        keys = np.sort(np.concatenate([g.astype(np.uint32) << np.uint32(13) | at.line[: len(g)].astype(np.uint32) for g in at.grams]))
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        out += np.bincount(keys >> np.uint32(13), weights=np.append(0.0, weights[k : k + 5000])[keys & np.uint32(8191)], minlength=len(out)).astype(np.int64)
    return out[:-1]


class Ratio:
    """Log likelihood ratio of each bucket: declining against other sentences."""

    def __init__(self, corpus: np.ndarray, sentences_: float):
        declining, telling = composed()
        p, q = counted(declining), counted(telling) + corpus
        logs = np.log((p + SMOOTHING) / (len(declining) + 2 * SMOOTHING)) - np.log((q + SMOOTHING) / (len(telling) + sentences_ + 2 * SMOOTHING))
        self.logs = np.append(np.where(p + q > 0, np.clip(logs, -CLIP, CLIP), 0.0), 0.0)

    def scores(self, lines: list[str]) -> np.ndarray:
        """Of each sentence the largest sum of mean log ratios over a stretch of it, each place less BIAS."""
        if not lines:
            return np.empty(0)
        at = _Places(_read(lines))
        total, n = np.zeros(len(at.line)), np.zeros(len(at.line))
        for g in at.grams:
            total[: len(g)] += self.logs[g]
            n[: len(g)] += g < 1 << BITS
        value = np.where(n > 0, total / np.maximum(n, 1) - BIAS, 0.0)
        value[at.left == 0] = 0.0
        # sums begin anew with each sentence: it lies below all earlier ones
        sums = np.concatenate([[0.0], np.cumsum(value)])
        line = np.concatenate([[0], at.line])
        low = sums - line * (np.abs(value).sum() + 1.0) * 2
        gain = low - np.minimum.accumulate(low)
        return np.maximum.reduceat(gain, np.searchsorted(line, np.arange(len(lines))))

    def declining(self, answers: list[str]) -> list[bool]:
        """Which answers have a sentence that declines and give no value besides."""
        parts = [sentences(a) for a in answers]
        hit = iter((self.scores([s for p in parts for s in p]) > BOUND).tolist())
        out = []
        for part in parts:
            told = [next(hit) for _ in part]
            out.append(any(told) and not any(_GIVEN.search(s) or self._gives(s) if x else _VALUE.search(s) for s, x in zip(part, told)))
        return out

    def _gives(self, sentence: str) -> bool:
        """Whether a part of a declining sentence that doesn't decline itself gives a value."""
        if not _VALUE.search(sentence):
            return False
        parts = [p for p in _CLAUSE.split(sentence) if p]
        return any(_VALUE.search(p) and x <= BOUND / 2 for p, x in zip(parts, self.scores(parts)))


def fitted(texts: DataFrame, answers: DataFrame) -> Ratio:
    """The ratio, with other sentences of all rows of ``texts`` and ``answers`` (a text column each), weighed as TEXTS and ANSWERS rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        met: dict[str, dict[str, int]] = {}

        def settle() -> None:
            for name, own in met.items():
                sums[name] = sums.get(name, 0) + counted(list(own), list(own.values()))
            met.clear()

        for b in batches:
            for name, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = met.setdefault(name, {})
                lines = sentences(t)
                for s in lines:
                    own[s] = own.get(s, 0) + 1
                sums[f"{name} n"] = sums.get(f"{name} n", 0) + np.array([1, len(lines)], np.int64)
            if sum(map(len, met.values())) > 200_000:
                settle()
        settle()
        yield counters(sums)

    rows = [x.toDF("text").where("text is not null").select(F.lit(n).alias("name"), "text") for n, x in (("texts", texts), ("answers", answers))]
    found = summed(rows[0].unionByName(rows[1]).mapInArrow(run, COUNTERS))
    corpus, total = np.zeros(1 << BITS), 0.0
    for name, most in (("texts", TEXTS), ("answers", ANSWERS)):
        if name in found:
            n, lines = found[f"{name} n"].tolist()
            corpus, total = corpus + found[name] * min(1.0, most / n), total + lines * min(1.0, most / n)
    return Ratio(corpus, total)
