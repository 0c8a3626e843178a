"""Sentences written for the detector of template residue, by kind and language, before its present rules.

They were worded without the corpus at hand. Every other one (``DEV``) may be looked at while rules are
written; the rest (``HELD``) only measures them.
"""

CASES = {
    ("error", "en"): """This site can't be reached
ERR_CONNECTION_REFUSED: the server refused the connection.
We couldn't load this page. Please refresh and try again.
500 Internal Server Error
Error 403: Forbidden
Your connection was interrupted
The file you requested does not exist.
Sorry, this video is unavailable.
Our website is currently undergoing maintenance.
You must be logged in to view this content.
Your session timed out due to inactivity.
The server is temporarily unable to service your request.
Oops! We can't seem to find the page you're looking for.
This account has been suspended.
Request blocked by security rules.
We are performing scheduled maintenance and will return soon.
This listing has been removed by its owner.
Too many requests, please slow down.
The service is unavailable at the moment.
Page cannot be displayed
An unexpected problem occurred while processing your request.
Access to this resource is denied.
Your login has expired, please sign in again.
Database connection failed
This link is no longer valid.
Whoops, looks like something broke.""",
    ("error", "de"): """Diese Seite existiert nicht mehr.
Der Server antwortet nicht. Bitte versuchen Sie es später erneut.
Es ist ein unerwarteter Fehler aufgetreten.
Sie haben keine Berechtigung, diese Seite anzuzeigen.
Ihre Sitzung ist abgelaufen, bitte melden Sie sich neu an.
Wegen Wartungsarbeiten ist unser Dienst vorübergehend nicht erreichbar.""",
    ("error", "fr"): """Cette page n'existe plus.
Une erreur inattendue est survenue.
Votre session a expiré, veuillez vous reconnecter.
Accès refusé
Le site est en cours de maintenance.
Le serveur ne répond pas, veuillez réessayer plus tard.""",
    ("error", "es"): """Esta página ya no está disponible.
Se ha producido un error inesperado.
Su sesión ha caducado, vuelva a iniciar sesión.
No tiene permiso para ver esta página.
El sitio se encuentra en mantenimiento.
El servidor no responde, inténtelo más tarde.""",
    ("error", "nl"): """Deze pagina bestaat niet meer.
Er is een onverwachte fout opgetreden.
Uw sessie is verlopen, log opnieuw in.
U heeft geen toegang tot deze pagina.
De site is tijdelijk offline wegens onderhoud.
De server reageert niet, probeer het later opnieuw.""",
    ("error", "id"): """Halaman ini sudah tidak tersedia.
Terjadi kesalahan yang tidak terduga.
Sesi Anda telah berakhir, silakan masuk kembali.
Anda tidak memiliki izin untuk membuka halaman ini.
Situs sedang dalam pemeliharaan.
Server tidak merespons, silakan coba lagi nanti.""",
    ("script", "en"): """This site runs only with JS on.
JavaScript is disabled in your browser.
You need to enable JavaScript to run this app.
Please allow cookies to continue.
Cookies are required to use this website.
Your browser is out of date, please upgrade it.
For full functionality of this site it is necessary to enable JavaScript.
This page works best with JavaScript turned on.
We use scripts to display this table; switch them on and reload.
Internet Explorer is no longer supported.
Just a moment while we verify your browser.
To continue, please turn on cookies in your browser settings.
Sorry, your web browser does not support this viewer.
JavaScript must be active for the map to load.""",
    ("script", "de"): """Ohne JavaScript kann diese Seite nicht angezeigt werden.
Bitte erlauben Sie Cookies in Ihrem Browser.
Ihr Browser ist veraltet.
JavaScript ist in Ihrem Browser deaktiviert.""",
    ("script", "fr"): """JavaScript est désactivé dans votre navigateur.
Veuillez accepter les cookies pour continuer.
Votre navigateur est obsolète.
Cette page nécessite JavaScript.""",
    ("script", "es"): """JavaScript está desactivado en su navegador.
Debe aceptar las cookies para continuar.
Su navegador está desactualizado.
Esta aplicación requiere JavaScript.""",
    ("script", "nl"): """JavaScript is uitgeschakeld in uw browser.
Accepteer cookies om verder te gaan.
Uw browser is verouderd.
Deze pagina heeft JavaScript nodig.""",
    ("script", "id"): """JavaScript dinonaktifkan di peramban Anda.
Izinkan cookie untuk melanjutkan.
Peramban Anda sudah usang.
Halaman ini membutuhkan JavaScript.""",
    ("filler", "en"): """TODO: write this section
Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium.
Lorem ipsum dolor sit amet, consectetur adipiscing elit.
[content to be added]
Text to be supplied.
This is just some dummy text to fill the space.
Insert a short description of the project here.
Type your message here.
Section under construction.
Body copy goes here.
xxxx xxxxx xxx xxxx xx
Placeholder: replace with the final introduction.
Your headline here
Coming soon: more content for this chapter.
TBD
This section will be completed later.
Click to edit the title
Write two or three sentences about the result.
At vero eos et accusamus et iusto odio dignissimos ducimus qui blanditiis.
test test test test""",
    ("filler", "de"): """Hier kommt noch Text hin.
Dies ist ein Blindtext.
Bitte hier eine kurze Beschreibung eintragen.
Platzhalter, wird später ersetzt.""",
    ("filler", "fr"): """Texte à venir.
Ceci est un texte de remplissage.
Insérez ici une courte description.
Votre titre ici""",
    ("filler", "es"): """Texto pendiente de redactar.
Este es un texto de relleno.
Escriba aquí una breve descripción.
Su título aquí""",
    ("filler", "nl"): """Tekst volgt nog.
Dit is een opvultekst.
Voer hier een korte beschrijving in.
Uw titel hier""",
    ("filler", "id"): """Teks menyusul.
Ini hanya teks pengisi.
Masukkan deskripsi singkat di sini.
Judul Anda di sini""",
    ("field", "en"): """Hello {0}, your order has shipped.
Hello [NAME], thank you for your visit.
Dear {{first_name}} {{last_name}},
The survey of <SITE NAME> took place on <DATE>.
Report for ${station} in %(month)s
Signed: __________ [signature]
Contact: [your email address]
We counted {% count %} boxes.
Value: #{total}
The lead was [TBD].
Visit us at %%UNSUBSCRIBE_URL%%.
Crew of ${crew.name}: {size} people""",
    ("field", "de"): """Sehr geehrte Frau [Nachname],
Der Bericht für {{ORT}} liegt vor.
Datum: [TT.MM.JJJJ]
Am <Datum> wurde gemessen.""",
    ("field", "fr"): """Bonjour [Prénom],
Le rapport de {{site}} est prêt.
Date : [JJ/MM/AAAA]
Relevé du <date>.""",
    ("field", "es"): """Estimado [Nombre],
El informe de {{lugar}} está listo.
Fecha: [DD/MM/AAAA]
Recuento del <fecha>.""",
    ("field", "nl"): """Beste [Naam],
Het verslag van {{plaats}} is klaar.
Datum: [DD-MM-JJJJ]
Telling op <datum>.""",
    ("field", "id"): """Yth. [Nama],
Laporan untuk {{lokasi}} sudah siap.
Tanggal: [HH/BB/TTTT]
Survei pada <tanggal>.""",
}
CLEAN = {
    "en": """The boat was under maintenance for two weeks.
The gate to the upper lake was not found until dusk.
Access to the pier was denied by the harbour master.
The old browser on the tablet was replaced in March.
We enabled JavaScript on the tablet and the map worked again.
The crew could not connect the pump to the battery.
The server room was closed for maintenance when we arrived.
The guide explains why a page shows "404 Not Found".
A volunteer said that the website was down on Sunday.
The template asks for the name of the site, and all crews filled it in.
Cookies and tea were served after the survey.
The session ended at noon with a short talk.
Something in the net went unnoticed for days.
The request for a second boat was refused by the office.
The permission of the owner is required to enter the site.
The script counts boxes by class and writes a table.
Path 404 leads along the canal to the weir.
The page of the logbook for May is missing.
Our account of the flood was published last year.
Boxes marked [1] and [2] were checked by hand.
Values are given as mean [min, max].
The footnote [see table 3] refers to the first survey.
The resource was not available to small crews in 2019.
The error was below one percent in all blocks.
Try the second slipway if the water is low.
Please contact the station before you bring a boat.
The link between rain and litter was strong.
Visitors must sign in at the gate and sign out when they leave.
We will be back at the weir in spring.
The database of the river board holds 40 years of levels.
The text of the sign was hard to read.
Add the blank samples here in the sequence and run the series.
The sample copy of the form is in the binder.
An unexpected storm ended the work.
The label file was not found for 12 images, which were left out.
If the tablet shows an error, restart it and note the time.
Latin names such as Pontederia crassipes are in the list.
The placeholder value -1 marks missing depths in the table.
Maintenance of the boom takes two days each month.
The new rules require a browser-based form for each dive.""",
    "de": """Das Boot war zwei Wochen in der Wartung.
Die Seite des Logbuchs fehlt.
Der Zugang zum Steg wurde vom Hafenmeister verweigert.
Die Sitzung begann um neun Uhr.
Der Fehler lag unter einem Prozent.
Der alte Browser wurde im März ersetzt.""",
    "fr": """Le bateau était en réparation pendant deux semaines.
La page du journal manque.
L'accès au quai a été interdit par le gardien hier.
La session a commencé à neuf heures.
L'erreur était inférieure à un pour cent.
Le navigateur de la tablette a été remplacé en mars.""",
    "es": """El barco estuvo dos semanas en el taller.
Falta la página del cuaderno.
El guarda negó el acceso al muelle ayer.
La sesión empezó a las nueve.
El error fue inferior al uno por ciento.
El navegador de la tableta se cambió en marzo.""",
    "nl": """De boot lag twee weken op de werf.
De pagina uit het logboek ontbreekt.
De havenmeester gaf geen toegang tot de steiger.
De sessie begon om negen uur.
De fout was kleiner dan een procent.
De browser op de tablet is in maart vervangen.""",
    "id": """Perahu diperbaiki selama dua minggu.
Halaman buku catatan itu hilang.
Penjaga tidak memberi akses ke dermaga kemarin.
Sesi dimulai pukul sembilan.
Kesalahannya di bawah satu persen.
Peramban di tablet diganti pada bulan Maret.""",
}


def cases(held: bool) -> list[tuple[str, str, str]]:
    """(kind, language, sentence) of one half."""
    return [(k, lang, s) for (k, lang), text in CASES.items() for i, s in enumerate(text.split("\n")) if i % 2 == held]


def clean(held: bool) -> list[tuple[str, str]]:
    return [(lang, s) for lang, text in CLEAN.items() for i, s in enumerate(text.split("\n")) if i % 2 == held]
