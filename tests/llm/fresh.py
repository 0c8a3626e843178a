"""Sentences for the detector of template residue, written after its rules.

The rules were changed once for what they missed of ``FRESH_CASES`` (recall 0.89, precision 0.98 then), and
not since ``LAST_CASES`` were written.
"""

FRESH_CASES = {
    ("error", "en"): """The article you were reading is no longer available.
Error 504 - Gateway Timeout
Our servers are down for maintenance, please check back later.
You are not authorized to view this document.
The requested file could not be located on this server.
This domain has expired.
An internal error occurred, please try again in a few minutes.
You have been logged out because of inactivity.
We are unable to process your request right now.
Whoops! Nothing to see here, the page was deleted.
503 Service Unavailable
Failed to load resource: the server responded with a status of 404""",
    ("error", "other"): """Die angeforderte Datei wurde nicht gefunden.
Le serveur a rencontré une erreur interne.
Lo sentimos, el servicio no está disponible en este momento.
De opgevraagde pagina kon niet worden gevonden.
Maaf, halaman yang Anda cari tidak ditemukan.
Zugriff verweigert""",
    ("script", "en"): """Turn on JavaScript and reload the page.
This form cannot be sent without cookies.
Your browser does not support HTML5 video.
Scripts are blocked in this browser.
Please use a different browser to open the map.
You must enable cookies before you can log in.""",
    ("script", "other"): """Bitte schalten Sie JavaScript ein.
Les cookies sont nécessaires pour utiliser ce site.
Habilite JavaScript para continuar.
Schakel cookies in om deze site te gebruiken.
Silakan aktifkan JavaScript di browser Anda.""",
    ("filler", "en"): """Description to follow.
[text to be supplied]
Write your introduction here.
Lorem ipsum dolor sit amet
Filler text for layout purposes only.
TODO: complete the methods section
blah blah blah blah
This paragraph is a placeholder and will be replaced.
Enter a title for the report here""",
    ("filler", "other"): """Hier folgt noch eine Beschreibung.
Texte à compléter.
Aquí va el texto de ejemplo.
Hier komt nog tekst.
Teks contoh untuk tata letak.""",
    ("field", "en"): """Dear {{ customer }}, your report is ready.
The visit to [STATION] took place on [DATE].
Hi {firstname}, welcome back!
Total: ${amount}
Prepared by <author name> for <client>.
We found %(count)s boxes near %(place)s.""",
    ("field", "other"): """Guten Tag {{name}},
Bonjour {prenom},
Hola [nombre], gracias por su visita.
Geachte heer [achternaam],
Halo {{nama}}, terima kasih.""",
}
FRESH_CLEAN = """The river path was closed by the council after the flood.
Our host at the station had repaired the pump.
The connection between the two ponds was blocked by hyacinth.
He wrote that the portal had been down all morning.
Visitors who lose their login should ask the office.
The document was moved to the archive in 2018.
Entry 404 in the list is a tyre.
The survey was refused permission in the first year.
Nobody could find the address of the landing stage.
The team replaced the broken browser kiosk at the gate.
JavaScript files are kept in the web folder of the repository.
The cookie tin holds the spare batteries.
The introduction was written later, after the second survey.
Fill the bottle to here and close the lid.
The sample text shows how annotators should describe a box.
Brackets such as [a] mark optional words.
The account describes the flood of May.
After the maintenance of the boom the site was open again.
The request came from the lake board.
Errors were counted by hand for each block.
Die Datei mit den Boxen liegt im Archiv.
Le serveur du café nous a prêté une barque.
El sitio de muestreo está junto al puente.
De toegang tot de haven is gratis.
Halaman sekolah dipakai untuk pelatihan.""".split("\n")
LAST_CASES = {
    ("error", "en"): """The connection to the server was lost, please retry later.
Sorry, this product page does not exist.
Unexpected error: the request could not be completed.
Your account has been locked out.
HTTP Error 400. The request is badly formed.
The portal is offline for planned maintenance.
Access forbidden
Please log in to continue.
This video has been removed by the user.
We can't reach the database right now.""",
    ("error", "other"): """Dieser Inhalt ist nicht mehr verfügbar.
La page demandée est introuvable.
Ha ocurrido un error, vuelva a intentarlo más tarde.
De website is in onderhoud.
Layanan sedang tidak tersedia.
Ihre Sitzung ist abgelaufen.""",
    ("script", "en"): """Please activate scripting to use the viewer.
This app requires cookies.
JavaScript is required for this page.
You are using an outdated browser, please upgrade your browser.
Without JavaScript the chart stays empty.""",
    ("script", "other"): """JavaScript muss aktiviert sein.
Veuillez activer les cookies.
Su navegador no es compatible.
Zet JavaScript aan om verder te gaan.
Halaman ini memerlukan JavaScript.""",
    ("filler", "en"): """Insert summary text here.
Content coming soon.
Dummy text, please replace.
This chapter is under construction.
Lorem ipsum
Describe the method in two sentences.
[abstract to be written]
xxx xxxx xxxxx xxx""",
    ("filler", "other"): """Blindtext für das Layout.
Insérez votre texte ici.
Escriba su resumen aquí.
Typ hier uw tekst.
Isi ringkasan di sini.""",
    ("field", "en"): """Survey of {{lake_name}} on {{date}}
To: <recipient>
The crew of [CREW NAME] counted [N] boxes.
{{#each items}} {{name}} {{/each}}
Your code is ${code}.
Hello %%FIRSTNAME%%""",
    ("field", "other"): """Datum: {datum}
Cher [Nom],
Fecha: {{fecha}}
Locatie: <locatie>
Nama: {{nama}}""",
}
LAST_CLEAN = """The page with the tide table was torn out.
The server brought tea to the crew.
A file of ducks crossed the path.
Our view of the dam was blocked by mist.
The service road was closed after the storm.
Retry counts are listed in table 2.
Contact times were logged by the office.
The crew had signed out before noon.
Maintenance logs are kept for ten years.
The error bars show one standard deviation.
We write the date here and the time below.
The script writes one row per image.
Cookies of mud broke off the bank.
The browser history was of no use to the audit.
The section on weeds was completed in June.
A dummy mooring was laid for the test.
The text follows the older report.
Set theory uses {a, b} for sets.
Items in <angle brackets> are optional, the manual explains.
Der Server steht im Keller der Station.
La page de garde est en couleur.
El servicio de barcos es diario.
De site aan het meer is mooi.
Situs itu berada di tepi danau.""".split("\n")
