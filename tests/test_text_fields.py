"""What a row costs in the trigram index."""

from catalog_engine.operators import prep as PR


def test_trigrams_of_an_artist_in_the_title_are_made_once(spark):
    df = spark.createDataFrame([("Some Band - Song",), ("Plain title",), (None,)], "title string")
    got = [r[0] for r in df.select(PR.text_fields()["text"]).collect()]
    assert len(got[0]) == len(set(got[0])) and {"som", "and", "ong"} <= set(got[0])
    assert {"pla", "unk", "ist"} <= set(got[1]) and "unk" in got[2]
