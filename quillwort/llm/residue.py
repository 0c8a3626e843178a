"""Texts that are, or contain, unfinished templates, filler, error pages or demands for scripts."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwort.session import durable, spread

#: A line is boilerplate of its host if it stands in this share of its documents. The least number only keeps
#: a line and its copy in a small host from counting; from 150 documents on the share alone decides.
RECURRENT, RECURRENT_SHARE = 3, 0.02

#: Recurrent lines, of eight bytes each, that are sent to every worker.
SENT = 1_000_000

# ---- fixed values: what counts as evidence --------------------------------------------------------
_NAME = r"[^\W\d_](?:[\w .'’-]{0,38}\w)?"
#: Element names that are markup, not fields.
_HTML = (
    "a|abbr|article|aside|b|blockquote|body|br|button|center|cite|code|dd|div|dl|dt|em|figure|font|footer|form|h[1-6]|head|header|hr|html"
    "|i|iframe|img|input|label|li|link|main|meta|nav|ol|option|p|pre|s|script|section|select|small|span|strong|style|sub|sup|svg|table"
    "|tbody|td|textarea|tfoot|th|thead|title|tr|u|ul|video|noscript|summary|details|mark|kbd|samp|var|time|unk|pad|mask|eos|bos"
)
#: Fields left unfilled. Read in the text as it is written, outside of code and quotation.
FIELD_FORMS = (
    rf"\{{\{{ ?{_NAME} ?\}}\}}",
    rf"\{{% ?{_NAME} ?%\}}",
    rf"<%=? ?{_NAME} ?%>",
    rf"[$#]\{{ ?{_NAME} ?\}}",
    rf"\$\({_NAME}\)",
    rf"%\({_NAME}\)[sd]",
    rf"(?<![{{$#%\w]){{{_NAME}}}(?!}})",
    rf"\[\[ ?{_NAME} ?\]\](?!\()",
    rf"<<{_NAME}>>",
    rf"(?<![<\w])<(?!(?:{_HTML})\b){_NAME}>(?!>)",
    rf"«{_NAME}»",
    rf"(?<![\d%\w])%{{1,2}}{_NAME}%{{1,2}}(?!\w)",
    rf"@@ ?{_NAME} ?@@",
    rf"##{_NAME}##",
    rf"\*\|{_NAME}\|\*",
    rf"\?\?\? ?{_NAME} ?\?\?\?",
    rf"(?<!\w)__{_NAME}__(?!\w)",
    r"\[(?:insert|enter|add|fill|your|to be|tbd|tba|tbc|todo|placeholder|ihr[e]?|su|votre|uw|isi|hier|inserte|insertar|inserer|einfugen)\b[^\[\]\n]{0,60}\]",
    r"(?<![\w{$#\\])\{\d\}",
    r"\[[^\[\]\n]{1,50} to be (?:added|written|supplied|completed|inserted|announced)\]",
    r"\[(?:DD|TT|JJ|MM|HH)[./-](?:DD|MM|BB)[./-](?:YYYY|JJJJ|AAAA|TTTT|YY|JJ|AA)\]",
    r"\b(?:dear|hello|hi|hallo|hola|halo|geehrte[rs]? \w+|liebe[rs]?|bonjour|chere?|estimad[oa]|querid[oa]|beste|geachte \w+|yth\.?) \[[^\[\]\n]{2,30}\]",
    r"(?-i:(?<![\w!])\[(?!(?:INFO|WARN|WARNING|ERROR|DEBUG|TRACE|FATAL|FAIL|PASS|SKIP|OK|NOTE|DONE)\])[A-Z][A-Z _]{2,30}\](?!\())",
    r"\[[^\[\]\n]{1,50} (?:here|pending|to come|goes here|tbd|tba|tbc|einfugen|erganzen|invullen|aqui|ici|di sini)\]",
)
#: What a page speaks of as its own subject; the second group is only a page's with a predicate that nothing else has.
_SURE = "page|website|web site|url|uri|link|listing|video|file|document|content|article|post|server|service|portal|application|app|viewer|account|login|session|request|database|connection|gateway|host|host name|domain|resource|profile"
_ALSO = "site|record|path|address|map|view|item|image|table|entry|data"
_START = r"(?:^|[.;:,!?|>()·›/–—-]\s*|\b(?:but|sorry|oops|whoops|unfortunately)\W+|©\s?(?:\w+ ){0,3})(?:(?:the|this|that|your|our|an?|requested|current) ){0,3}(?:\w+ ){0,3}?"
_WHICH = r"(?: (?:you|that you)(?: are|'re| were|'ve| have)? \w+(?: (?:for|to \w+))?| /\S*| \S*/\S*)?"
_NOT = r"(?:not|n't|n.t)"
_GONE = rf"(?:(?:is|was|are|were|can|could|does|did|has|have|may|might)(?: {_NOT}|n'?t)|(?:is|are|was) no longer|cannot|can't|couldn't|never|no longer)(?: (?:be|been|currently|longer|yet))?"
_ENDS = r"(?=\W*$|\W*[,.;:(]| (?:on|at|from|in) (?:this|the|our|your) (?:server|moment|site|time|address|url|region|country)| (?:right )?now\b| any ?more\b| since \d{4}\b| or\b| and\b| due\b| because\b| by (?:its|the) (?:owner|author|user|server|firewall|gateway|administrator)| while\b)"
#: Errors, refusals, expired sessions and maintenance: words of which one is needed, and the form. Read sentence by sentence, in lower case, without accents.
ERROR_FORMS = (
    ("found|load|display|reach|open|exist|availab|accessib|process|respond|valid|locat|connect|complete", rf"{_START}(?:{_SURE}|{_ALSO}){_WHICH} {_GONE} (?:found|loaded|displayed|reached|opened|exists?|existed|available|accessible|reachable|processed|completed|established|responding|respond|load|valid|located|accessed|active|online|supported){_ENDS}"),
    ("unavailable|unreachable|offline|down|maintenance|suspended|terminated|interrupted|blocked|refused|denied|rejected|removed|deleted|moved|expired|timed|crashed|failed|ended|disabled|reset", rf"{_START}(?:{_SURE}){_WHICH} (?:(?:is|was|are|were|has|have)(?: been)?(?: currently| temporarily| now| already)? )?(?:unavailable|unreachable|offline|down|suspended|terminated|interrupted|blocked|refused|denied|rejected|removed|deleted|moved|expired|timed out|crashed|failed|reset)(?: unexpectedly| or never existed)?{_ENDS}"),
    ("session", r"\byour session (?:has |is |was )?(?:expired|timed out|ended|closed)\b|^\W*session (?:expired|timed out)"),
    ("maintenance", rf"(?:{_START}(?:{_SURE}|site|we)(?:'re| is| are| was)(?: currently| temporarily)? |^\W*(?:currently |temporarily )?)(?:(?:down|offline|closed|unavailable) for |under |undergoing |in |performing |doing )(?:(?:scheduled|planned|routine) )?maintenance\b|^\W*(?:scheduled|planned|routine|site) maintenance\b"),
    ("permission|authori|allowed", rf"\byou (?:do {_NOT}|don't|are {_NOT}|aren't|lack|have no)\b.{{0,12}}\b(?:permission|authori[sz]ed|authori[sz]ation|allowed) ?(?:to (?:view|open|access|see|use|edit|perform)\b|\W*$)|^\W*not authori[sz]ed to (?:view|open|access)\b"),
    ("log|sign", r"\byou (?:must|need to|have to) (?:be )?(?:logged|signed|log|sign) ?in\b|\byou(?:'ve| have)? (?:been |were )(?:signed|logged|locked) out\b|(?:^|please |, ?|[.:;] ?|and )(?:sign|log) ?in (?:again|to (?:continue|view|see|access|proceed|your account))\b|^\W*(?:login|log-in|sign-in|authentication) required\b"),
    ("find|load|locate|open|process|connect|reach|unable to", rf"\bwe (?:could {_NOT}|couldn't|can(?:no|')t|cannot|can't seem to|are unable to|were unable to) (?:find|load|locate|open|process|connect to|reach) (?:the|this|that|your|any)\b.{{0,12}}\b(?:{_SURE}|{_ALSO})\b|(?:^|[:,;] ?)(?:could {_NOT}|couldn't|cannot|can't|unable to|failed to) (?:connect to|reach|load|find|open) (?:the |this |that )?(?:{_SURE}|{_ALSO})\b|\b(?:could {_NOT}|couldn't|cannot|can't|unable to|failed to) connect to (?:the )?(?:database|server|host)\b|{_START}(?:{_SURE}) (?:is|was)(?: temporarily| currently)? unable to\b"),
    ("looking for", r"\bpage you(?:'re| are| were) looking for\b"),
    ("nothing lives", r"\bnothing lives at this (?:address|url)\b"),
    ("wrong|something|oops|whoops|uh-oh", r"\bsomething (?:went wrong|broke|failed)\b|^\W*(?:oops|whoops|uh-oh)\b"),
    ("unexpected|unknown|internal|fatal|unhandled", rf"(?:^|[.;:,!?|>–—-]\s*|{_START}(?:{_SURE}) (?:hit|encountered|returned|had|ran into) )an? (?:unexpected|unknown|internal|fatal|unhandled) (?:server |application )?(?:error|problem|exception|condition)\b"),
    ("error", r"(?:^|[.;:,!?|>–—-]\s*)an? (?:\w+ )?error (?:has |was )?(?:occurred|encountered|happened)\b"),
    ("logged|recorded", r"\b(?:incident|error) (?:was|has been) (?:logged|recorded) (?:as|under)\b"),
    ("try|refresh|reload|slow down", r"(?:^|[.;:,!?–—-]\s*|\bplease |\band )(?:try|retry)(?: again| it)?(?: (?:later|shortly|soon|in (?:a few|some|\d+) (?:seconds|minutes|moments|hours)))\b|(?:^|[.;:,!?–—-]\s*|\bplease |\band )try again\W*$|(?:^|\bplease |[.;:,]\s*)(?:refresh|reload) (?:the|this) page\b|\brefresh and try again\b|^\W*slow down and retry\b"),
    ("back|return", r"\bwe(?:'ll| will)? (?:be back|return) (?:shortly|soon|online)\b|\bwill return (?:shortly|soon)\W*$|\bcheck back (?:shortly|soon|later)\b"),
    ("contact", r"(?:^|\bplease |\bor |[.;:,]\s*)contact (?:the |your |our )?(?:site |system |web ?)?(?:administrator|admin|webmaster|support team|help ?desk)\b"),
    ("http|error|fehler|erreur|fout|kesalahan|status|code", r"^\W*(?:http(?:/\d(?:\.\d)?)?|error|fehler|erreur|fout|kesalahan|status|code)\W{0,3}(?:error|code|status)?\W{0,3}[45]\d\d\b(?! (?:boxes|images|files|rows|m\b|km\b|items))"),
    ("40|41|42|50", r"^\W*(?:40[0-9]|41[0-9]|42[0-9]|50[0-9])\s*(?:[|:–—-] ?[a-z]|error\b|not found|forbidden|bad (?:gateway|request)|service unavailable|internal server|gateway time|unauthori[sz]ed|too many)|\bhttp(?:/\d(?:\.\d)?)? (?:error )?[45]\d\d (?:not found|forbidden|bad (?:gateway|request)|service unavailable|internal server|gateway time|unauthori[sz]ed|too many)"),
    ("found|denied|forbidden|authori|error|gateway|unavailable|request|required|time", r"^\W*(?:.{0,40}[|>:–—-] ?|\S+(?: \S+){0,2} › )?(?:(?:page |file )?not found|access (?:denied|forbidden)|forbidden|unauthori[sz]ed|internal server error|bad gateway|service (?:temporarily )?unavailable|gateway time-?out(?: while .{1,30})?|too many requests|permission denied|bad request|connection (?:refused|reset|timed out)|request timed out)(?=\W*$|, please)"),
    ("too many requests|gateway time|err_|upstream", r"\b(?:too many requests|gateway time-?out|err_[a-z]{3,}|upstream gave no answer)\b"),
    ("request|access|connection", r"^\W*(?:your )?(?:request|access|connection)(?: to (?:this|the) (?:resource|page|site|server|content|document))? (?:(?:was|is|has been) )?(?:blocked|denied|refused|rejected|restricted|forbidden)(?=\W*$| by (?:the |our )?(?:security|firewall|gateway|server|administrator|policy|network|system))"),
    ("was refused|has been refused|was blocked|has been blocked|was rejected", r"\byour request (?:was|has been) (?:refused|blocked|rejected)\b"),
    ("seite|datei|dienst|server|inhalt|dokument|datensatz|link", r"\b(?:(?:web)?seite|datei|dienst|inhalt|dokument|datensatz|link|server)\b.{0,40}\b(?:nicht (?:mehr )?(?:gefunden|erreichbar|verfugbar|geladen|vorhanden|gultig)|existiert (?:nicht|leider)|antwortet nicht|reagiert nicht)\b"),
    ("fehler|sitzung|anmelden|melden sie|zugriff|berechtigung|wartungsarbeiten|versuchen sie|spater", r"\bein(?: \w+)? (?:server)?fehler (?:ist )?aufgetreten\b|\bsitzung (?:ist )?abgelaufen\b|\bmelden sie sich\b.{0,12}\b(?:neu|erneut|wieder) an\b|\b(?:neu|erneut|wieder) anmelden\b|\bzugriff (?:wurde )?verweigert\b|\bkeine berechtigung\b|\bwartungsarbeiten\b|\bversuchen sie es\b.{0,12}\b(?:spater|erneut|nochmals?)\b|\bspater (?:erneut|noch ?einmal|wieder)\b|\binterner serverfehler\b"),
    ("page|site|fichier|document|contenu|lien|service|serveur|fiche", r"\b(?:page|site|fichier|document|contenu|lien|service|serveur|fiche)\b.{0,30}(?:\bn'existe (?:plus|pas)|\bintrouvable\b|\bnon trouve|\bn'est (?:plus|pas) (?:disponible|accessible)|\bn'a pas (?:pu |ete )|\bindisponible\b|\bne repond pas\b)"),
    ("erreur|session|reessay|acces|maintenance|reconnect|permission|autoris|droit", r"\berreur\b.{0,15}(?:est survenue|s.est produite)\b|\bsession (?:a |est )?expire|\breessay(?:ez|er)\b|^\W*acces (?:refuse|interdit)\b|\ben (?:cours de )?maintenance\b|\breconnect(?:ez-vous|er)\b|\bn'avez pas (?:la permission|l'autorisation|acces|les droits)|\berreur interne\b"),
    ("pagina|sitio|servicio|servidor|enlace|sistema", r"\b(?:pagina|sitio|servicio|servidor|enlace|sistema)\b.{0,30}\b(?:no (?:existe|encontrada|se encuentra|se encontro|disponible|esta disponible|responde)|en mantenimiento)\b"),
    ("error|sesion|permiso|intentelo|acceso denegado|salio mal|mantenimiento", r"\b(?:ocurrido|producido|produjo|ocurrio) un error\b|\bsesion (?:ha )?(?:caducado|expirado|caduco|expiro)\b|\binici(?:ar|e) sesion\b|\bno tiene (?:permiso|acceso|autorizacion)\b|\bintentelo (?:de nuevo|otra vez|mas tarde)\b|^\W*(?:.{0,30}[|>:–—-] ?)?acceso denegado\b|\balgo salio mal\b|\berror interno\b|^\W*en mantenimiento\b"),
    ("pagina|site|dienst|server|bestand", r"\b(?:pagina|site|website|dienst|server|bestand|document)\b.{0,30}\b(?:bestaat niet|niet (?:meer )?(?:worden )?(?:gevonden|geladen|geopend|beschikbaar|bereikbaar)|reageert niet|offline|wegens onderhoud|in onderhoud)\b"),
    ("fout|iets mis|probeer|sessie|opnieuw|toegang|onderhoud|toestemming", r"\bfout opgetreden\b|\ber ging iets mis\b|\bprobeer het\b.{0,12}\b(?:later|opnieuw|nog)\b|\bsessie is verlopen\b|\b(?:log|meld u) opnieuw (?:in|aan)\b|\btoegang geweigerd\b|\bgeen (?:toegang tot|toestemming om) deze\b|^\W*wegens onderhoud\b|\binterne serverfout\b"),
    ("halaman|situs|layanan|server|tautan", r"\b(?:halaman|situs|layanan|server|tautan)\b.{0,25}\b(?:tidak (?:ditemukan|tersedia|ada|merespons?|dapat diakses)|dalam (?:perbaikan|pemeliharaan))\b"),
    ("kesalahan|coba lagi|akses ditolak|sesi|silakan masuk|izin|pemeliharaan|perbaikan", r"\bterjadi kesalahan\b|\bcoba lagi\b|^\W*(?:.{0,30}[|>:–—-] ?)?akses ditolak\b|\bsesi (?:anda )?(?:telah |sudah )?(?:berakhir|habis|kedaluwarsa|kadaluarsa)\b|\bsilakan masuk (?:lagi|kembali)\b|\btidak memiliki (?:izin|akses)\b|^\W*(?:sedang )?dalam (?:perbaikan|pemeliharaan)\b"),
)
_S = r"\b(?:java ?scripts?|js|active scripting|scripting|scripts|script support|cookies?|skripten?)\b"
_ASKED = "script|cookie|skript|js"
#: Notices that scripts, cookies or another browser are needed.
SCRIPT_FORMS = (
    (_ASKED, rf"\b(?:enable|activate|turn on|switch on|turning on|allow|accept|unblock|permit)\b(?! (?:the|a|an|for) (?!cookies|use)).{{0,25}}{_S}|\b(?:needs?|requires?|runs? only with|works? (?:only|best) with|works? properly without|properly without|load without|without)\b(?: \w+){{0,2}} ?{_S}"),
    (_ASKED, rf"{_S}.{{0,60}}\b(?:(?:must|has to|have to|needs? to|should) be|(?:is|are)(?: currently)?) (?:enabled|disabled|allowed|required|necessary|needed|active|on|off|blocked|turned off|switched off|turned on|switched on)(?=\W*$|\W*[,;:(]| (?:to|for|by|in|before|on this|and)\b)|{_S}.{{0,20}}\b(?:turned|switched) (?:on|off)\W*$|{_S}.{{0,40}}\b(?:switch|turn) (?:them|it) on\b"),
    ("browser|internet explorer", r"\byour (?:web ?)?browser\b.{0,12}\b(?:not support\w*|unsupported|not supported|out of date|out-of-date|outdated|too old|no longer supported|has it disabled|blocks)\b|\b(?:internet explorer|this browser|browser) (?:is|are) (?:not|no longer|un)\s?supported\b|\b(?:newer|modern|different|another|supported|up-to-date|recent) (?:web )?browser (?:is (?:needed|required)|to (?:view|see|use|open|display)|version)|\b(?:update|upgrade) your browser\b|\b(?:checking|verify|verifying) your browser\b"),
    ("noscript", r"<noscript>|\bnoscript\b"),
    (_ASKED, rf"\b(?:aktivier|erlaub|akzeptier|zulass|schalt)\w*\b.{{0,25}}{_S}|{_S}.{{0,25}}\b(?:aktivier\w+|deaktiviert|erforderlich|benotigt|einschalten|ausgeschaltet|zulassen)\b|\b(?:ohne|benotigt|erfordert|braucht)\b.{{0,15}}{_S}"),
    (_ASKED, rf"\b(?:activ(?:er|ez)|autoris(?:er|ez)|accept(?:er|ez)|necessite|requiert|sans)\b.{{0,25}}{_S}|{_S}.{{0,15}}\b(?:desactives?|requis|necessaires?|bloques?)\b"),
    (_ASKED, rf"\b(?:active|activar|habilite|habilitar|aceptar|acepte|permita|permitir|necesita|requiere|sin)\b.{{0,25}}{_S}|{_S}.{{0,15}}\b(?:habilitad\w+|deshabilitad\w+|desactivad\w+|activad\w+|necesari\w+)\b"),
    (_ASKED, rf"\b(?:zet|schakel|sta)\b.{{0,12}}{_S}.{{0,15}}\b(?:aan|in|toe)\b|\baccepteer\b.{{0,12}}{_S}|\b(?:vereist|heeft|zonder)\b.{{0,15}}{_S}|{_S}.{{0,15}}\b(?:uitgeschakeld|ingeschakeld|vereist|nodig)\b"),
    (_ASKED, rf"\b(?:aktifkan|nyalakan|hidupkan|izinkan|terima|membutuhkan|memerlukan|tanpa)\b.{{0,15}}{_S}|{_S}.{{0,15}}\b(?:dinonaktifkan|diaktifkan|diperlukan|harus)\b"),
    ("browser|navig|naveg|peramban", r"\bbrowser (?:ist veraltet|wird nicht unterstutzt|is verouderd|wordt niet ondersteund|anda (?:tidak didukung|sudah usang))\b|\bnavigateur (?:n.est (?:pas|plus)|est (?:obsolete|trop ancien))|\bmettez a jour votre navigateur\b|\bnavegador (?:no (?:es compatible|compatible|admite)|esta (?:desactualizado|obsoleto))\b|\bactualice su navegador\b|\bperamban (?:anda )?(?:tidak didukung|sudah usang)\b|\bperbarui (?:peramban|browser)\b"),
)
_WRITTEN = "text|copy|content|section|paragraph|chapter|description|body|caption|summary|introduction"
#: Filler in place of text still to be written.
FILLER_FORMS = (
    ("lorem|ipsum|consectetu|adipisc|perspiciatis|voluptat|dignissimos|incididunt", r"\b(?:lorem|ipsum|consectetu\w+|adipisc\w+|perspiciatis|voluptat\w+|dignissimos|incididunt)\b"),
    ("xxx|…|....|. . |____", r"\b(?:x{3,}\s+){2,}x{3,}\b|(?:…\s*){4,}|(?:\.\s?){8,}|(?<!\S)_{6,}(?!\S)"),
    ("asdf", r"\basdf\b.*\bjkl\b|\basdf\W+asdf\b|\bqwer(?:ty)?\W+asdf\b"),
    ("bla|foo|yada", r"\b(blah|bla|foo|yada)\b(?:\W+\1\b){2,}"),
    ("test", r"^(?:test\b\W*){3,}$"),
    ("placeholder|dummy|filler|sample|example", r"\b(?:dummy|filler|place ?holder|sample|example) (?:copy|text|content|paragraph)\b(?! (?:of|from|for the|was|were|is|are|shows?|showed|lists?|gives?|helps?|in the)\b)|^\W*place ?holder\s*[:.,–—-]|\b(?:is|as) an? place ?holder\b(?! for (?:missing|unknown|empty))"),
    ("to come|to follow|pending|coming soon|later|supplied|to be |construction|completed", rf"\b(?:{_WRITTEN}|details)\b.{{0,12}}\b(?:to come|to follow|pending|coming soon)\b|\b(?:{_WRITTEN})\b (?:is )?(?:to|will) be (?:supplied|added|written|completed|provided|inserted|filled in|replaced)\b|^\W*(?:more )?coming soon\b|^\W*(?:this |the )?(?:page|section|chapter|site) (?:is )?(?:still )?under construction\b|^\W*to be (?:added|written|completed|supplied|announced|determined)\W*$"),
    ("todo|tbd|tba|tbc|fixme", r"^\W*(?:todo|fixme)\W+(?:write|add|fill|insert|complete|finish|expand|describe|replace)\b|^\W*(?:tbd|tba|tbc)\W*$"),
    ("here|this box|this field|this space", r"^\W*(?:\w+[^.]{0,30}[:|>–—-] )?your (?:\w+ ){1,2}(?:goes )?here\W*$|\byour text (?:goes )?here\b|\b(?:copy|text|content|title) goes here\b|(?:^|[:|>–—-] |\bplease )(?:insert|enter|type|add|write|put|describe) (?:\S+ ){0,8}(?:here|in this (?:box|field|space))(?=\W*$|\W*\()"),
    ("click", r"\bclick (?:here )?to (?:add|edit) (?:the |your |a )?(?:sub)?(?:title|text|notes?)\b"),
    ("replace", r"\breplace (?:this|me|with)\b.{0,12}\b(?:paragraph|text|sentence|section|final)\b|\bwill be replaced before (?:release|publication|launch)\b|^\W*replace (?:me|before publishing)\b"),
    ("heading|body text", r"\bheading [1-9]\W*$|^\W*heading \d(?: body text| heading)|^\W*body text\b"),
    ("sentence|words|lines|paragraph", r"^\W*(?:describe|write|summari[sz]e|explain)\b.{3,90}\bin (?:two|one|a few|three|\d) (?:or \w+ )?(?:sentences|words|lines)\W*$|^\W*(?:write|give|provide) (?:\w+ ){1,3}(?:sentences|words|paragraphs?|lines) (?:about|on|for)\b"),
    ("(max", r"\(max\W? \d+ (?:words|characters)\)|\(max\W?$"),
    ("text|platzhalter|hier", r"\bblindtext\b|\bplatzhalter(?:text)?\b|\bmustertext\b|\bfulltext\b(?! search)|\bhier (?:steht|kommt|folgt) (?:spater|noch|bald)\b|\b(?:text|beschreibung|inhalt) folgt\b|\bhier (?:\w+ ){0,4}(?:eingeben|einfugen|eintragen)\b"),
    ("texte|ici|completer", r"\btexte (?:a (?:venir|completer|inserer|rediger)|provisoire|factice|d.?exemple|de remplissage)\b|\b(?:saisissez|inserez|ecrivez|entrez|redigez) (?:ici|votre texte)\b|\bvotre (?:texte|titre|nom|contenu) ici\b|^\W*a completer\W*$"),
    ("texto|aqui", r"\btexto (?:de (?:ejemplo|relleno|muestra|prueba)|pendiente|provisional)\b|\b(?:escrib[ae]|inserte|introduzca|anada|ingrese) aqui\b|\b(?:inserte|introduzca|escriba) el texto\b|\bsu (?:texto|titulo|nombre|contenido) aqui\b"),
    ("tekst|hier", r"\btekst (?:volgt|komt) (?:nog|later)\b|\bhier (?:komt|volgt) (?:nog|later)\b|\b(?:voorbeeld|opvul|plaatshouder)tekst\b|\b(?:voer|vul|typ|schrijf|plaats) hier\b|\buw (?:tekst|titel|naam) hier\b"),
    ("teks|sini|diganti", r"\bteks (?:menyusul|pengisi|contoh|pengganti|dummy)\b|\b(?:tulis|isi|ketik|masukkan)\w*\b.{0,35}\bdi sini\b|\b(?:judul|teks|nama) anda di sini\b|\bharap diganti\b"),
)
#: What passes on what a page said, before the words of the page.
SAYS = r"\b(?:said|says|answered|replied|told|reported|showed|shows|saw|noted|wrote|written|explains?|explained|means|meant|mentions?|why|whether)\b"
#: Somebody's doings in the past: a sentence with them tells a story, it isn't a page's own message.
TELLS = (
    r"\b(?:we|i|he|she|they|(?:the|a|our|two|all|both|most|some) (?:\w+ )?(?:crews?|team|keepers?|volunteers?|annotators?|students?|boats?|office|staff))"
    r" (?:(?!encountered|moved|removed|expired|needed)\w{2,}ed|saw|got|went|took|came|left|kept|began|made|wrote|ran|sent|met|lost)\b"
)
#: A demand that the sentence says is met.
MET = r"\b(?:is|are|was|were|has been|have been) (?:now |already |since )?(?:enabled|installed|allowed|fixed|restored|switched on|turned on) (?:on|at|for|with|everywhere|again)\b"
#: A sentence with one of these explains a field that it quotes.
EXPLAINS = r"\b(?:template|placeholder|fields?|replaces?|expands?|written|variable|wrapper|syntax|filled in)\b"
#: Function words of the languages at hand; filler in make-believe Latin has none.
_FUNCTION = frozenset(
    "the a an of to in is was were are and or with for from at by on it we not der die das und ein eine ist im den dem mit von auf nicht"
    " le la les un une des du de et est dans pour sur pas el los las una del y en es con por que het een van is op te dat niet voor met"
    " yang di ke dari dan itu ini pada untuk tidak dengan as but if so".split()
)
_LATIN = re.compile(r"(?:um|us|is|it|am|as|or|ere|are|que|alem|endo|ica|osa|iter|tur|unt|ibus|orum|arum|em|at|et|os)$")
# ---------------------------------------------------------------------------------------------------

_FIELDS = re.compile("|".join(FIELD_FORMS), re.IGNORECASE)
#: (kind, form) by number, and the automaton that finds the words of which a form needs one, with the forms' numbers.
_RULES = [(kind, re.compile(form)) for kind, forms in (("filler", FILLER_FORMS), ("script", SCRIPT_FORMS), ("error", ERROR_FORMS)) for _, form in forms]


def _automaton() -> ahocorasick.Automaton:
    needs: dict[str, list[int]] = {}
    for number, (words, _) in enumerate([*FILLER_FORMS, *SCRIPT_FORMS, *ERROR_FORMS]):
        for word in words.split("|"):
            needs.setdefault(word, []).append(number)
    out = ahocorasick.Automaton()
    for word, numbers in needs.items():
        out.add_word(word, tuple(numbers))
    out.make_automaton()
    return out


_NEEDS = _automaton()
_SAYS, _TELLS, _MET, _EXPLAINS = re.compile(SAYS), re.compile(TELLS), re.compile(MET), re.compile(EXPLAINS)
_FENCE = re.compile(r"```.*?```|~~~.*?~~~", re.DOTALL)
_CODE = re.compile(r"`[^`\n]{1,200}`|(?m:^\s*\$ .*$)")
_QUOTE = re.compile(r"\"[^\"\n]{1,80}\"|“[^”\n]{1,80}”|„[^“”\n]{1,80}[“”]|(?<!\w)'[^'\n]{3,80}'(?!\w)")
_MARKS = re.compile(r"[\u0300-\u036f]+")
_LETTERS = re.compile(r"[a-z]+")
_NUMBERED = re.compile(r"\S*\d\S*")
_DIGIT = re.compile(r"\d")
_MAYBE_FIELD = re.compile(r"[{}\[<«@#?]|__|%\w|%\(|\$\(|\*\|")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_DAMAGED = re.compile(r"[ÂÃâ][\u0080-¿€‚-™Œ-ƒ]{1,2}")


def _repair(text: str) -> str:
    """UTF-8 that was read as a Western one-byte encoding, read again where that is possible."""

    def again(m: re.Match) -> str:
        try:
            return m.group().encode("cp1252").decode()
        except UnicodeError:
            return m.group()

    return _DAMAGED.sub(again, text)


def plain(text: str) -> str:
    """Lower case without accents and with plain apostrophes, as the sentence patterns expect it. Lines stay lines."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.replace("’", "'").replace("…", "\0")).replace("\0", "…")
        text = _MARKS.sub("", text)
    return re.sub(r"[ \t]+", " ", text.lower())


def _blank(m: re.Match) -> str:
    return re.sub(r"[^\n]", " ", m.group())


def _latin_words(words: list[str]) -> bool:
    return len(words) >= 6 and _FUNCTION.isdisjoint(words) and sum(bool(_LATIN.search(w)) for w in words) >= 0.7 * len(words)


def _pseudo_latin(said: str) -> bool:
    """Whether the words of a sentence, or those between two words with digits, are make-believe Latin."""
    rough = said.split()
    free = 0
    for word in rough:  # six words in a row without a function word are needed anyway
        free = 0 if word in _FUNCTION else free + 1
        if free == 6:
            break
    else:
        return False
    if _FUNCTION.isdisjoint(rough) and _latin_words(_LETTERS.findall(said)):
        return True
    return len(rough) > 6 and bool(_DIGIT.search(said)) and any(_latin_words(_LETTERS.findall(run)) for run in _NUMBERED.split(said))


def _reported(kind: str, said: str, end: int) -> bool:
    """Whether a sentence only passes on, tells or has settled what a form found up to ``end``."""
    if kind == "filler":
        return False
    return bool(_SAYS.search(said, 0, end) or _TELLS.search(said) or (kind == "script" and _MET.search(said, end)))


def evidence(text: str | None) -> list[tuple[int, str]]:
    """(line number from 0, kind) of each sentence that is evidence; kind is field, filler, error or script.

    Null and empty texts hold none. Fenced and inline code, and quotations, are not the text's own
    words; neither are sentences that report or explain. Encoding damage, character references,
    letter case and accents do not matter.
    """
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", re.sub(r"[​-‏⁠﻿­]", "", _repair(text).replace("…", ""))).replace("", "…")
    if "&" in text:
        text = re.sub(r"&(?:\w{1,8}|#\d{1,6});", lambda m: html.unescape(m.group()).replace("\n", " "), text)
    if "`" in text or "$ " in text or "~~~" in text:
        text = _CODE.sub(_blank, _FENCE.sub(_blank, text))
    out = []
    lines = text.split("\n")
    if _MAYBE_FIELD.search(text):
        for number, line in enumerate(lines):
            for m in _FIELDS.finditer(line) if _MAYBE_FIELD.search(line) else ():
                begin = max(line.rfind(". ", 0, m.start()), 0)
                quoted = any(q.start() < m.start() and m.end() < q.end() for q in _QUOTE.finditer(line))
                if not quoted or not _EXPLAINS.search(line[begin : m.end() + 80].lower()):
                    out.append((number, "field"))
                    break
    said_all = plain(_QUOTE.sub(" ", text) if '"' in text or "'" in text or "“" in text or "„" in text else text)
    needed: dict[int, set[int]] = {}
    for at, numbers in _NEEDS.iter(said_all):
        needed.setdefault(at, set()).update(numbers)
    places = sorted(needed)
    at = next_ = 0
    for number, line in enumerate(said_all.split("\n")):
        until = at + len(line)
        for first, last in _spans(line) if line else ():
            rules: set[int] = set()
            while next_ < len(places) and places[next_] < at + last:
                if places[next_] >= at + first:
                    rules |= needed[places[next_]]
                next_ += 1
            said = line[first:last].strip()
            for rule in sorted(rules):
                kind, form = _RULES[rule]
                found = form.search(said)
                if found and not _reported(kind, said, found.end()):
                    out.append((number, kind))
                    break
            else:
                if _pseudo_latin(said):
                    out.append((number, "filler"))
        while next_ < len(places) and places[next_] <= until:
            next_ += 1
        at = until + 1
    return out


def _spans(line: str) -> Iterator[tuple[int, int]]:
    """Where the sentences of a line begin and end."""
    at = 0
    for m in _SENTENCE.finditer(line):
        yield at, m.start()
        at = m.end()
    yield at, len(line)


def line_keys(text: Column) -> Column:
    """A hash of each line in normal form: lower case, each run of digits and white space as one blank; 0 for lines of nothing else."""
    norm = F.regexp_replace(F.lower(text), r"(?U)[\d\s&&[^\n]]+", " ")
    return F.transform(F.split(norm, "\n"), lambda x: F.when(F.trim(x) == "", F.lit(0).cast("long")).otherwise(F.xxhash64(F.trim(x))))


def recurrent_lines(documents: DataFrame, text: str, host: Column, least: int = RECURRENT, share: float = RECURRENT_SHARE) -> DataFrame:
    """(host, line): lines that stand in at least ``least`` documents and ``share`` of the documents of a host."""
    keyed = documents.where(F.col(text).isNotNull()).select(host.alias("host"), F.array_distinct(line_keys(F.col(text))).alias("lines"))
    n = keyed.groupBy("host").agg(F.count("*").alias("n_docs"))
    counted = keyed.select("host", F.explode("lines").alias("line")).where("line <> 0").groupBy("host", "line").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least).join(n, "host").where(F.col("n") >= share * F.col("n_docs")).select("host", "line")


def without_boilerplate(documents: DataFrame, doc_id: str, text: str, host: Column) -> DataFrame:
    """(doc, text): each text without its host's recurrent lines; a text of nothing else has them as its own.

    Lines that open or close code stay, as what they enclose would be taken for text. A host has at
    most as many recurrent lines as an average document divided by ``RECURRENT_SHARE``; they are one
    row per host, sent to the workers if all of them are at most ``SENT`` and merge-joined by host otherwise.
    """
    lines = durable(recurrent_lines(documents, text, host).groupBy("host").agg(F.collect_set("line").alias("recurrent")))
    n = lines.agg(F.sum(F.size("recurrent"))).first()[0] or 0
    docs = documents.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"), host.alias("host"))
    joined = docs.join(F.broadcast(lines) if n <= SENT else lines.hint("merge"), "host", "left")
    keep = lambda x, k: F.when((k != 0) & (x.rlike(r"^\s*(?:```|~~~)") | ~F.array_contains("recurrent", k)), x)
    own = F.array_join(F.array_compact(F.zip_with(F.split("text", "\n"), line_keys(F.col("text")), keep)), "\n")
    return joined.select("doc", F.when(F.col("recurrent").isNull(), F.col("text")).otherwise(F.coalesce(F.nullif(own, F.lit("")), "text")).alias("text"))


def residue(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(doc_id, kind): each document with evidence in what remains of it without its host's boilerplate.

    Normalised lines are counted by host, lines that recur (``recurrent_lines``) are subtracted, and
    what is left is searched. A kind comes out once per document. Null, empty and blank texts are no
    cases; a null host is a host like others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, kinds = [], []
            for i, value in enumerate(b.column(1).to_pylist()):
                for kind in sorted({k for _, k in evidence(value)}):
                    rows.append(i)
                    kinds.append(kind)
            if rows:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(kinds, pa.string())], ["doc", "kind"])

    left = without_boilerplate(documents, doc_id, text, F.coalesce(F.lower(F.trim(F.col(host))), F.lit("")))
    return spread(left).mapInArrow(run, "doc long, kind string").distinct().withColumnRenamed("doc", doc_id)
