import pytest

from panelforge.llm import sentences

# Each text is written with | where a unit ends.
CASES = [
    "Prices are in const. 1987 units, excl. transfers.| See Fig. 3 and Tab. 4 for the list.|",
    "Dr. D. Clemmelola of the desk signed it on Jan. 24, 1993.| Version 9.64.108 fails; 9.81 does not.|",
    "The scan began at 9 a.m. Monday.| Our contact answered at 5 p.m. on Tuesday.| He left at 5 p.m.| She stayed.|",
    "Then batch A, then batch B.| One reviewer asked.| B. Zaekreune asked.|",
    'He asked "Why 150 rows?" and left.| Mr. B. West wrote: "It is wrong. Load it again."| "Who changed it?" asked Tom.|',
    "(The sheet was scanned by hand.)| The total (5 persons, approx. 7 percent) was accepted.| Do they use p. 92?!| Yes.|",
    "It had 5 in 1994... or so they claim.| It was taken from https://desk.example/a/31.csv and never edited.|",
    "iPanel is new.| iPanel exports drop it.|No space here.|Next one.|",
    "Häfen, Brunnen usw. wurden z. B. im Jahr 1964 gezählt.| Der Rest betrifft Kanäle usw.| Das Amt zählte am 28. März 2013.| Im 9. Halbjahr 1999.| Die Werte (ca. 12 Einw.) stehen in Abb. 3 bzw. Tab. 4.|",
    "Herr Semskyria sagte: „Das war die Nr. 157.“| „Die Zeile ist falsch. Bitte neu laden“, schrieb er.|",
    "« La ligne est fausse. Merci », écrit M. Skeind.| Le saut est-il réel ?| Mme X a demandé : « Pourquoi ? »| M. A. Brun a relu le 28 avr. 2005.|",
    "¿Es real?| ¡Alto!| La Sra. T. Clem preguntó: «¿Por qué?»| Faltan p. ej. las de 1992, etc.| El total (aprox. 28 hab.) no cambió.|",
    "В 1994 г. бюро считало.| Порты и т. д. считали.| См. рис. 3 и табл. 4.| Остались каналы и т. д.| Д-р Куз проверил (см. с. 5).| «Неверно. Снова», — написал он.|",
    "空单元格保持为空（见第9页。）|他问道：“为什么？”|「单位改了吗？」A. Semskyria问。|原因……不明。|停止！|",
    "担当者は「なぜか？」と尋ねた。|「誤りです。もう一度。」とB. Fooは書いた。|空欄（手引きを参照。）|本当ですか？|",
    "खाली खाने खाली हैं।| डॉ. M. Clem ने पृ. 5 देखा।| उसने लिखा, \"गलत है। फिर करें।\"| रोकें!|",
    "انظر ص. 58 من الدليل.| راجع د. Clouxsoune الجدول.| هل هي حقيقية؟| قال M. Zend: «الصف خطأ. أعيدوا تحميله.»| أوقفوا!|",
    "ผู้ตรวจ B. Houl อ่านตารางอีกครั้ง| โปรดหยุดการนำเข้าทันที| รุ่น 7.50 แทนที่รุ่น 9.31 แล้ว|",
    "A heading|\n\nText goes on\nover lines.| More.|\r\n\r\n1) ask R. Houl (tel. ext. 62)|\r\n2) Load it. Then stop.|\r\n\r\n- one|\n- two|",
    "Wrapped up in\n1984.| The end|",
    # Words that are abbreviations only sometimes.
    "The answer was no.| Then she left.|", "He set it to the max.| Then it broke.|", "They studied art.| It was fun.|", "We met in Jan.| He was late.|", "Vitamin C.| Then we left.|", "El no.| Pero sí.|",
    "See No. 5, Art. IV and Fig. A for it.| It is max. 3 m.| We met in Jan. 1999.|", "Er meldete 53 Mio. Personen.| Es waren 3 Mio.| Dann nicht mehr.|", "The dog has a hab.| Tel. 5.|",
]


@pytest.mark.parametrize("marked", CASES)
def test_units(marked):
    parts = marked.split("|")[:-1]
    text, ends = "", []
    for p in parts:
        text += p
        ends.append(len(text))
    assert [text[a:b] for a, b in sentences.units(text)] == [p.strip() for p in parts]
    assert [b for _, b in sentences.units(text)] == ends


@pytest.mark.parametrize("text", ["", None, " \n\n \t ", "\n", '"', "((((", "。。。", "...", "! ? !", "﻿", "a" * 100_000, "( " * 3000, '"a ' * 3000, "Ok. " * 20000])
def test_edges(text):
    got = sentences.units(text)
    assert all(a < b <= len(text) for a, b in got) and [b for _, b in got] == sorted({b for _, b in got})
    if text:
        assert "".join(text[a:b] for a, b in got).replace(" ", "").replace("\n", "") == "".join(text.split()) or not text.strip()


def test_code_points_beyond_the_basic_plane():
    assert sentences.units("😀 Yes. No.") == [(0, 6), (7, 10)]


def test_table(spark):
    docs = spark.createDataFrame([(1, "One. Two.", "x"), (1, "One. Two.", "x"), (2, None, "x"), (3, "", "x"), (4, " ", "x")], "doc_id bigint, text string, end_pos string")
    got = sorted((r["doc_id"], r["unit_no"], r["end_pos"]) for r in sentences.sentence_units(docs).collect())
    assert got == [(1, 0, 4), (1, 0, 4), (1, 1, 9), (1, 1, 9)]
    assert sentences.sentence_units(docs.limit(0)).count() == 0
