import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.llm.sentences import sentences, units

CASES = {
    "abbreviations": ("Dr. Lee J. Kim came at 9 a.m. to no. 9 St. Mary lane, e.g. by bus. It cost 2.5 kb, cf. Fig. 2 and Tab. 3. We saw cats, dogs, etc. The end.", 4),
    "speech inside": ('He wrote: "Keep it. Do not merge." and left. Next one.', 2),
    "speech as unit": ('"It ends here." The next begins.', 2),
    "brackets": ("Set it to 2 (the default is 10. Larger is worse) now. (See Sect. 3.2 too.) Done.", 3),
    "ellipsis": ("The signal faded ... and came back. Why 3 and not 4?! Nobody knows.", 3),
    "german": ("Am 26. Mai kam die 2. Auswertung, vgl. Abb. 8 und Tab. 11. Die linke Flanke, d. h. z. B. hier. „Sie endet bei 54.“ Ende.", 4),
    "french": ("M. Dupont a dit : « Gardez-le. Ne changez rien. » puis il partit. L'îlot est-il complet ? Oui.", 3),
    "spanish": ("La Dra. Paz anotó aprox. 7 huecos, p. ej. aquí. ¿Está? ¡Sí!", 3),
    "russian": ("Длина 20,4 т. п. н. правее, см. рис. 5. Куратор написал: «Да. Нет.» и ушёл. Конец.", 3),
    "chinese": ("截断点为4.1kb。“重复止于此。”他写道：“保留。不要。”然后关闭。完整吗？分成两组……其中一组没有。", 5),
    "japanese": ("担当者は「残す。しない。」と書いた。島は完全ですか？「終わる。」次へ。", 4),
    "hindi": ("डॉ. Sen ने लिखा। सब ठीक है॥ क्या यह पूरा है? vocB1 छोटा है।", 4),
    "arabic": ("قال د. Netis إن العائلة كبيرة. هل هي مكتملة؟ نعم؛ انظر الشكل 11.", 3),
    "thai": ("เกาะนี้ยังไม่สมบูรณ์ ไม่พบสิ่งใด หน้าต่างยาว 29.8 กิโลเบสและมี 4356 ยีน", 3),
    "blocks": ("Steps\n\nOne line\nwraps here. Two.\n\n- a. B\n- b\n\n1. x\n2. y\r\n\r\nEnd", 8),
    "wrapped number": ("As shown in Tab.\n11. The flank ends.", 2),
    "open bracket": ("A ( is left open. The rest goes on.", 2),
    "nested lists": ("Plan:\n1. one\n   - a. B\n   - c\n   1. deep\n   2. deeper\n2. two\n3. three\n\nEnd", 9),
    "a list goes on past 999": ("\n".join(f"{i}. x" for i in range(998, 1003)), 5),
    "a year begins a line": ("It was late.\n\n1998. It was cold. So it stayed.", 4),
    "quote in bracket": ("He left (and said “Stop. Now.” twice.) quickly. Then came (she wrote “Yes.”) No more.", 3),
    "mark left open before a pair": ("A “quote left (open. Here.) Next one. Last.", 3),
    "long word before a stop": ("A" + "b" * 300 + " and Dr. " + "c" * 300 + ". New one.", 2),
    "nothing": (" \n\t", 0),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    text, n = CASES[name]
    parts = [text[a:b] for a, b in units(text)]
    assert len(parts) == n, parts


@settings(max_examples=200, deadline=None)
@given(st.text('aB .!?"“”(«»)。？「」…\n-1१।ก', max_size=60))
def test_units_cover_the_text_in_order(text):
    at, rest = 0, ""
    for a, b in units(text):
        assert at <= a < b and not text[a].isspace() and not text[b - 1].isspace()
        rest += text[at:a]
        at = b
    assert not (rest + text[at:]).strip()


def test_table(spark):
    df = spark.createDataFrame([(1, "Abc de. Fg hi."), (2, None), (3, ""), (None, "x"), (1, "Abc de. Fg hi.")], "doc_id bigint, text string").withColumn("key", F.lit(0)).withColumn("t", F.lit("z"))
    assert rows(sentences(df)) == [(None, 1, 0, 1), (1, 1, 0, 7), (1, 1, 0, 7), (1, 2, 8, 14), (1, 2, 8, 14)]
    assert sentences(df.where("false")).count() == 0


def test_very_long_text():
    text = "This is a sentence of some length. " * 30_000
    assert len(units(text)) == 30_000 and len(units("x" * 500_000)) == 1 and len(units('"' * 5001)) >= 1
