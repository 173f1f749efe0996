"""Published papers, and names told by files, offices and companies."""

import datetime

from vitrine.functions import file_names, published


def read(spark, function, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    rows = df.select("i", function(df["t"]).alias("d")).orderBy("i").collect()
    found = [r["d"].asDict() if hasattr(r["d"], "asDict") else r["d"] for r in rows]
    return found[0] if len(found) == 1 else found


REPORT = """<style>imprumut</style><p>MONITORUL OFICIAL nr. 391 din 30 aprilie 2025</p><p>Denumirea partidului politic: Partidul Social Democrat
</p><p>Donații și cotizații primite de partid în anul 2024</p><p>Cuprins: cuantumul total | 1,00</p>
<p>Situația centralizată a veniturilor</p><table><tr><td>Cuantumul total</td><td>5.651,20</td></tr></table>
Total cheltuieli: lei 1.234,50 <table><tr><td>Semnătura reprezentantului legal</td><td>Ion  POP</td></tr></table>"""


def test_report(spark):
    assert read(spark, published.party_report, REPORT) == {
        "party": "Partidul Social Democrat", "code": "PSD", "year": 2024, "kinds": ["cotizatii", "donatii", "cheltuieli"], "income": 5651.2,
        "spending": 1234.5, "signatory": "Ion POP", "gazette": 391, "published": datetime.date(2025, 4, 30),
    }


def test_report_of_other_forms(spark):
    found = read(spark, published.party_report, '<ul class="S_EMT_BDY"> <li>USR</li></ul> raport pe anul 2019, Total venituri: 7,50 lei', "MONITORUL OFICIAL nr. 5 din 31 februarie 2020", None)
    assert [f["party"] for f in found] == ["USR", "", ""] and [f["year"] for f in found] == [2019, None, None] and found[0]["income"] == 7.5
    assert found[0]["kinds"] == ["venituri_totale"] and found[1]["gazette"] == 5 and found[1]["published"] is None and found[2]["kinds"] == []


def test_bill(spark):
    page = 'Guvernul <a href="structura2015.mp?cam=2&amp;idm=77">A</a><a href="structura.mp?idm=5">B</a><a href="structura.mp?idm=77">A</a> Initiator:  12 deputati \n x'
    assert read(spark, published.bill, page) == {"initiators": ["5", "77"], "n_initiators": 12, "government": True, "line": "12 deputati"}
    late = read(spark, published.bill, "Initiator: A <" + "x" * 400 + "guvernul", "y" * 3000 + "Guvernul", None)
    assert [f["government"] for f in late] == [False] * 3 and [f["n_initiators"] for f in late] == [0] * 3 and late[0]["line"] == "A"


def test_motion(spark):
    page = "<b>Titlu</b>: Moțiune  despre drumuri <i>Data</i> 05.03.2020 RESPINSĂ, pentru moţiune: 120, împotrivă - 210 <a class=x href=\"m/1.PDF\">t</a>"
    assert read(spark, published.motion, page) == {"title": "Moțiune despre drumuri", "day": datetime.date(2020, 3, 5), "outcome": "Respinsă", "votes_for": 120, "votes_against": 210, "paper": "m/1.PDF"}
    assert read(spark, published.motion, None) == {"title": "", "day": None, "outcome": None, "votes_for": None, "votes_against": None, "paper": None}


def test_papers(spark):
    assert read(spark, published.paper_kind, "http://x/EM12.pdf", "http://x/pvc3.pdf", "x/zz1.pdf", "x/em.pdf", "em/1.pdf", None) == ["expunere_motive", "proces_verbal", "alt", "alt", "alt", "alt"]


def test_curriculum(spark):
    text = "Ion Pop\n Facultatea de Drept \r\nFacultatea de Drept\n2001 - 2005 inginer\nhobby\n" + "z" * 120
    assert read(spark, published.curriculum, text) == {"status": "ok", "education": "Facultatea de Drept", "experience": "2001 - 2005 inginer"}
    assert read(spark, published.curriculum, "Facultatea", None) == [{"status": "scanned", "education": "", "experience": ""}] * 2
    page = "<nav>Facultatea de Drept din Cluj</nav><p>Absolvit Universitatea din Cluj</p><p>studii diverse neclare</p><p>Director general, 2010</p>"
    assert read(spark, published.curriculum_page, page) == {"education": "Absolvit Universitatea din Cluj", "experience": "Director general, 2010"}
    assert read(spark, published.curriculum_page, "<p>menu</p>", None) == [None, None]


def test_names_of_files(spark):
    urls = ["http://x/DA_Popescu-Ion.D_2020.pdf", "http://x/declaratie%20avere%20%C8%98erban.PDF", "x/Popescu.pdf", "x/DA_Pop.pdf", "x/formular_2021.pdf", "x/100%_Ana_Pop.pdf", "x/15.03.2019 Ana Pop semnat", None, ""]
    assert read(spark, file_names.name_of_file, *urls) == ["POPESCU ION", "ȘERBAN", None, None, None, "ANA POP", "ANA POP", None, None]


def test_made_up_names_of_files_are_no_markers(spark):
    from vitrine.plans.published import names_of_files

    keys = spark.createDataFrame([(63625,), (507921,), (645271,), (815609,), (8,), (2,)], "c_custkey long")  # ANONIM, MARTIE, NUMIRE, SEMNAT
    found = {r["k"]: r["by_file"] for r in names_of_files(lambda name: keys).collect()}
    assert found == {63625: "ANONIM", 507921: "MARTIE", 645271: "NUMIRE ȘERBAN", 815609: "SEMNAT", 8: "POPESCU AAAAAS", 2: None}


def test_names_of_offices(spark):
    offices = ["Deputatul: Ion Pop", "SENATOARE Ana", "Senator Ana  Maria Ș", "Deputati Ion Pop", "Primar Ion Pop", None]
    assert read(spark, file_names.name_of_office, *offices) == ["ION POP", None, "ANA MARIA", None, None, None]


def test_sorted_words(spark):
    assert read(spark, file_names.sorted_words, "Șerban d'Ion Ion", None) == ["D ION ION SERBAN", ""]
    assert read(spark, lambda c: file_names.sorted_words(c, 2), "Șerban d'Ion Ion") == "ION ION SERBAN"


def test_brands(spark):
    names = ['Compania Națională "Poșta Română" SA', "Metrorex SA", "Societatea de Transport Aerian TAROM SA", "SA", None]
    assert read(spark, file_names.brands, *names) == [["postaromana", "posta"], ["metrorex"], ["tarom", "aerian", "aerian-tarom"], [], []]
