"""Input columns that are called like results, or like names the operators use inside, in any case."""

from covey.llm import bpe, language, mainpage, media, mixing, neardup, pii, quality, repeats, vectors

NAMES = "lang_pred Score SPANS plain_spans text_ n_bytes Payload DIGEST elements Copy MIX_KEY point check tokens node family component_id Kept n_shingles s1 s2 tiles _text doc evidence host_posterior ids N_Tokens _row _made _host _path _sh _sp _piece".split()


def test_clashing_names(spark):
    names = [n for n in NAMES]
    rows = [(1, "one two three. a@b.example", "en", "s", *["x"] * len(names)), (None, None, None, None, *[None] * len(names))]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names)
    df = spark.createDataFrame(rows, schema)
    assert language.predict(df, language.learn(df)).count() == 2
    assert pii.detect(df).count() == 2 and pii.redact(df).count() == 2
    assert media.payloads(df).count() == 2
    assert mainpage.main_text(df, {}, "text", "Score").count() == 2
    assert mixing.mix(df, budget=2).columns[-2:] == ["copy", "mix_key"]
    assert neardup.near_duplicates(df).count() == 2
    assert repeats.repeated_passages(df)[0].count() == 2
    scored = quality.evidence(quality.sited(df), {"weights": None, "share": 0.5})
    assert quality.judge(scored, quality.posteriors(scored, 0.5)).count() == 2
    short = df
    assert bpe.round_trip(short, keep_ids=True).count() == 2 and bpe.decode(bpe.encode(short)).count() == 2
    vectors_ = df.selectExpr("doc_id AS vec_id", "array(1.0D, 2.0D) AS embedding", "point", "node", "family")
    assert vectors.near_vectors(vectors_).count() == 2
