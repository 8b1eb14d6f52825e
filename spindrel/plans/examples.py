"""Small synthetic pages and people for the queries that the shared tables can't exercise. All names are invented."""

BASE = "https://www.b-tu.de/qisserver3/rds"
MODULE_EN = """<html><head><title>Modul 90001 - Demo</title></head><body><h1>Demo Module</h1>
<table><tr><td>Cookie</td><td>session</td></tr></table>
<table>
<tr><td>Module Number:</td><td>90001 - Phase-out Module</td></tr>
<tr><td>Module Title:</td><td>Demo&nbsp;Systems</td></tr>
<tr><td></td><td>Demosysteme</td></tr>
<tr><td>Credits:</td><td>6</td></tr>
<tr><td>Contents:</td><td><ul><li>A</li><li>B</li></ul></td></tr>
<tr><td>Phase-out Module:</td><td>Since: 01.01.2030 <ul><li><a href="/m?pord.pordnr=7">90002 Next</a></li></ul></td></tr>
<tr><td>Components to be offered in the Current Semester:</td><td><ul><li><a href="rds?veranstaltung.veranstid=11">900 Lecture</a></li><li>Exam</li></ul></td></tr>
<tr><td>Unknown Row:</td><td>kept</td></tr>
<tr><td></td><td>Open to all.</td></tr>
</table></body></html>"""
MODULE_DE = MODULE_EN.replace("Module Number", "Modulnummer").replace("Module Title", "Modultitel").replace("Credits", "Leistungspunkte").replace("90001", "90003")
ERROR_PAGE = "<html><body><h1>Error</h1><table><tr><td>Cookie</td><td>session</td></tr></table></body></html>"
EVENT = """<table summary="Grunddaten zur Veranstaltung"><tr><th>Veranstaltungsart</th><td>Vorlesung</td></tr>
<tr><th>Semester</th><td>SS 2030</td><th>SWS</th><td>2.0</td></tr></table>
<table summary="Übersicht über alle Veranstaltungstermine"><caption>Termine Gruppe: 1-Gruppe</caption>
<tr><th></th><th>Tag</th><th>Zeit</th><th>Neue Spalte</th></tr>
<tr><td><a href="d?id=1"></a></td><td>Mo.</td><td>09:15</td><td>x</td></tr></table>
<table summary="Übersicht über die zugehörigen Einrichtungen"><tr><td>Institut X</td></tr></table>
<table><caption>Sonstiges</caption><tr><th>K</th></tr><tr><td>v</td></tr></table>"""
CATALOGUE = f"""<p>3 Treffer</p><table summary="Suchergebnis">
<tr><td><a href="{BASE}?state=modulBeschrDetailInfo&amp;pord.pordnr=5">a</a></td></tr>
<tr><td><a href="{BASE}?pord.pordnr=5&amp;state=modulBeschrDetailInfo&amp;x=1">b</a></td></tr>
<tr><td><a href="https://elsewhere.example/rds?state=modulBeschrDetailInfo&amp;pord.pordnr=6">c</a></td></tr>
<tr><td><a href="{BASE}?state=other&amp;pord.pordnr=8">d</a></td></tr>
<tr><td><a href="{BASE}?state=modulBeschrDetailInfo&amp;pord.pordnr=7">e</a></td></tr></table>"""
FACULTY = """<nav class="breadcrumb-section"><ul><li><a><span itemprop="name">Fakultät 1</span></a></li></ul></nav><div class="user-content">
<h2>Institut A</h2><h3>Gruppe</h3><table><thead><tr><th>Fachgebiet</th><th>Leitung</th></tr></thead>
<tr><td><a href="/fg-x">FG X</a></td><td>Prof. Dr. Klara Lang</td></tr><tr><td>FG Y</td><td>N. N.</td></tr></table>
<h2>ehemalige Fachgebiete</h2><table><tr><td><a href="https://other.example/z">FG Z</a></td><td></td></tr></table></div>"""
CHAIR = """<title>FG X - BTU</title><nav class="top-bar"><div class="top-bar-left"><ul class="dropdown menu"><li class="nav-item"><a href="/fg-x/team">Team</a>
<ul class="submenu"><li><a href="/fg-x/team">Sekretariat</a></li><li><a href="/fg-x/anfahrt">Anfahrt</a></li><li><a href="/fg-x/ada">Ada Muster</a></li></ul></li>
<li class="nav-item"><a href="/fg-x/lehre">Lehre</a></li></ul></div></nav><div class="user-content"><h1>FG X</h1></div>"""
TEAM = """<nav class="hide-for-print"><h3 class="subnav__header">Team</h3><ul class="side-nav"><li class="subnav-item"><a href="/fg-x/bo"><dfn>2:</dfn> Bo</a></li></ul></nav>
<div class="user-content"><h2>Sekretariat</h2><div class="ce-bodytext"><p><strong>Ada Muster</strong><br>T +49 355 000-1<br>F +49 355 000-2<br>Hauptgebäude, Raum 3.39<br>ada.muster(at)b-tu.de<br>Irgendwas</p></div></div>"""
PERSON = """<div class="user-content"><h2>Klara Lang</h2><div class="ce-bodytext"><p>klara.lang@b-tu.de</p></div>
<a class="accordion-title" href="#cv">Lebenslauf</a><div class="accordion-content" id="cv"><p>Born.</p></div></div>"""
#: URL -> page of a small site.
SITE = {
    f"{BASE}?pord.pordnr=5": MODULE_EN,
    f"{BASE}?pord.pordnr=6": ERROR_PAGE,
    f"{BASE}?pord.pordnr=7": MODULE_DE,
    f"{BASE}?veranstaltung.veranstid=11": EVENT,
    "https://www.b-tu.de/fakultaet1/x": FACULTY,
    "https://www.b-tu.de/fg-x": CHAIR,
    "https://www.b-tu.de/fg-x/team": TEAM,
    "https://www.b-tu.de/fg-x/bo": PERSON,
    "https://www.b-tu.de/fg-x/ada": TEAM,
    "https://www.b-tu.de/fg-x/anfahrt": "<div class='user-content'><h1>Anfahrt</h1></div>",
}
#: chair_id, seq, name, emails, career
SIGHTINGS = [
    ("A", [1], "Ada Muster", ["ada.muster@x.de"], "short"),
    ("A", [2], "Dr. Ada Muster", [], "longer career"),
    ("A", [3], "Bo Beispiel", ["fg@x.de"], None),
    ("B", [4], "Ada Muster", ["muster@x.de"], None),
    ("B", [5], "Ida Beispiel", [], None),
]
#: chair_id, faculty, faculty_number, institute, chair, chair_url, chair_is_former, status, team_menu_found
CHAIRS = [
    ("A", "Fakultät 1", 1, "I1", "A", "https://www.b-tu.de/a", False, "crawled", True),
    ("B", "Fakultät 2", 2, None, "B", "https://www.b-tu.de/b", True, "crawled", False),
    ("C", "Fakultät 2", 2, None, "C", None, False, "no_link", False),
]


class SiteSession:
    """A transport that serves SITE; what it doesn't have is a 404."""

    def reset(self) -> None:
        pass

    def get(self, url: str):
        from spindrel.sources.fetch import Response

        return Response(url, 200, SITE[url]) if url in SITE else Response(url, 404, "")
