import random

from tests.llm.conftest import ODD, SF
from textloom.llm.language import LanguageModel, fit_language_model, identify_language, with_language
from textloom.llm.queries import op5_language

SENTENCES = {
    "en": ["the cat and the dog of this house", "that is what they were thinking about", "with the other things from there"],
    "de": ["der hund und die katze in dem haus", "das ist was sie nicht gedacht haben", "mit den anderen sachen von dort"],
    "fr": ["le chien et le chat dans la maison", "ce que les autres ont dit est vrai", "avec des choses qui sont là pour eux"],
}


def learned(spark):
    rows = [(k, t + f" {w}", lang) for lang, ts in SENTENCES.items() for k, t in enumerate(ts) for w in ("a", "bb", "ccc")]
    return fit_language_model(spark.createDataFrame(rows, "doc_id int, text string, lang string"))


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    rows = op5_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert 150 < len(out) < 350 and sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_family_first_then_pairs(spark):
    model = learned(spark)
    assert model.families == {"germanic": ("de", "en"), "romance": ("fr",)}
    assert ("de", "en") in model.machines and ("germanic", "") in model.machines and len(model.machines) == 3
    df = spark.createDataFrame([(k, t.upper()) for k, ts in enumerate(SENTENCES.values()) for t in ts], "doc_id int, text string")
    assert all(r.lang_pred == list(SENTENCES)[r.doc_id] for r in identify_language(df, model).collect())


def test_odd_rows(spark, odd, none):
    model = learned(spark)
    rows = identify_language(odd, model).collect()
    letters = [t is not None and any(c.isalpha() for c in t) for _, t in ODD]
    assert len(rows) == len(ODD) and sum(r.lang_pred != "und" for r in rows) == sum(letters)
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    kept = with_language(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(letters)
    assert identify_language(none, model).count() == 0 and with_language(none, model).count() == 0


def test_few_or_no_languages(spark, odd, none):
    one = fit_language_model(spark.createDataFrame([("some words", "xx"), (None, "yy"), ("text", None)], "text string, lang string"))
    assert {r.lang_pred for r in identify_language(odd.where("doc_id in (5, 7)"), one).collect()} <= {"xx", "yy"}
    empty = fit_language_model(none)
    assert empty.families == {} and {r.lang_pred for r in identify_language(odd, empty).collect()} == {"und"}
    assert isinstance(empty, LanguageModel)


def test_noise_and_languages_that_were_not_learned_are_rejected(spark):
    """Clean texts of the learned languages stay, short ones too."""
    rng = random.Random(9)
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    model = fit_language_model(docs)
    finnish = (
        "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto "
        "heidän on toimittava toisiaan kohtaan veljeyden hengessä jokaisella on oikeus elämään vapauteen ja turvallisuuteen"
    ).split()
    polish = (
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem "
        "i powinni postępować wobec innych w duchu braterstwa każdy człowiek ma prawo do życia wolności i bezpieczeństwa"
    ).split()
    bad = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(3, 11))) for _ in range(120)) for _ in range(30)]
    bad += [" ".join(rng.choices(words, k=150)) for words in (finnish, polish) for _ in range(30)]
    clean = [r.text for r in docs.where("n_chars > 20").orderBy("doc_id").limit(300).collect()]
    short = [" ".join(t.split()[:k]) for k, t in zip((1, 2, 3, 5, 8, 13) * 20, clean[:120])]
    rows = [(k, t) for k, t in enumerate(bad + clean + short)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    usual = {r.doc_id: r.usual for r in identify_language(df, model).collect()}
    kept = {r.doc_id for r in with_language(df, model).collect()}
    assert sum(k in kept for k in range(len(bad))) <= 2
    letters = {k for k, t in rows if k >= len(bad) and any(c.isalpha() for c in t)}
    assert letters - kept == set(), sorted((usual[k], rows[k][1][:60]) for k in letters - kept)
