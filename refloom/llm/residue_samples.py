"""Labelled passages from which the residue models are fitted (fixed values)."""

from __future__ import annotations

import itertools

SLOTS = ("title", "abstract", "author_name", "year", "journal", "body_html", "doc.title", "item.notes", "citation.pages", "YOUR TITLE", "INSERT ABSTRACT HERE", "ABSTRACT", "Name of author", "keywords", "pages", "author", "date", "name", "content", "description")
MARKS = ("{{%s}}", "{{ %s }}", "${%s}", "<%%= %s %%>", "{%% block %s %%}", "[[%s]]", "[%s]", "{%s}", "#{%s}", "@@%s@@", "__%s__", "%%%s%%", "<%s>", "&lt;%s&gt;", "«%s»")
LABELS = ("Title", "Abstract", "Author", "Year", "Pages", "Keywords")

#: What programs print where a value is missing.
PRINTED = ("[object Object]", "by undefined, published null", "Array ( [0] => Array )", "Volume %d, pages %s to %s", "Authors: NaN et al.", "#REF!", "#VALUE!", "Title: undefined", "Year: null")

#: Words of pseudo-Latin filler.
LATIN = set(
    """lorem ipsum dolor dolo sit amet consectetur consec adipiscing elit sed sedul do eiusmod tempor incididunt ut labore et dolore magna magnes aliqua aliqu enim ad minim veniam
    quis quisto nostrud nostrem exercitation ullamco ullam laboris nisi aliquip ex ea commodo consequat duis aute auctar irure in reprehenderit voluptate velit esse cillum eu fugiat nulla
    pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum fervit lacus mattim ornat porrim pulvin vitar viverra mauris
    vestibulum pellentesque habitant morbi tristique senectus netus malesuada fames turpis egestas vitae suspendisse potenti curabitur""".split()
)

FILLER = (
    "TBD TBD TBD", "tba tba tba", "asdf asdf jkl asdf", "xxxx xxxxx xx xxxx", "blah blah blah", "Text to follow.", "Content to follow.", "Sample text. Replace it with your own.",
    "Your abstract goes here.", "Your text goes here.", "Insert introduction.", "Insert text here.", "This is a placeholder paragraph for layout only.", "Placeholder text.",
    "Hier steht später der Text.", "Text folgt.", "Platzhaltertext.", "Contenu à venir.", "Texte à venir.", "Texte de remplissage.", "Texto de relleno.", "Contenido pendiente.",
    "Dear Sir or Madam XXXX,", "translation missing: en.record.abstract",
)

_THINGS = ("The page", "This record", "This address", "This item", "Item 12", "The file you followed a link to", "The requested full text", "Sorry, the document “ab”")
_FAILS = ("could not be found", "does not exist or was renamed", "is not available right now", "is no longer here", "failed to load", "took too long to answer", "has been withdrawn from the server", "returned status 404", "has been moved or deleted")
ERRORS = tuple(f"{a} {b}." for a, b in itertools.product(_THINGS, _FAILS)) + (
    "Error 404: the page you asked for could not be found.", "Internal server error", "502 Not Found", "404 Not Found", "403 Forbidden", "Bad gateway", "The requested address /ab/12 was not found on this server.",
    "We are sorry, something went wrong while loading “ab”.", "Oops! This address could not be found. Try the search box instead.", "Check the spelling of the address.", "Please come back later.", "Contact the desk if this goes on.",
    "Too many requests from your address; wait 12 seconds.", "Please confirm that you are not a robot to continue reading.", "Go back to the start page.", "Back to home page",
    "Your session has expired. Sign in again to read this document.", "Gateway timed out while fetching the full text (12 s).", "Service temporarily unavailable: maintenance until 12:00.",
    "Access denied. You do not have permission to view item 12.",
    "Fehler 404: Die gesuchte Seite wurde nicht gefunden.", "Die Seite existiert nicht mehr.", "Die Seite wurde verschoben. Zurück zur Startseite.", "Die Seite lieferte den Status 404.", "Die Seite ist derzeit nicht erreichbar.", "Die Seite konnte nicht geladen werden.",
    "Der Eintrag 12 existiert nicht mehr.", "Das gewünschte Dokument ist derzeit nicht erreichbar.", "Der Zugriff auf Eintrag 12 wurde verweigert.", "Ihre Sitzung ist abgelaufen. Bitte melden Sie sich neu an.", "Bitte versuchen Sie es später erneut.",
    "Erreur 404 : la page demandée est introuvable.", "La page n'existe plus. Retour à l'accueil.", "La page a été déplacée.", "La page a renvoyé le code 404.", "La page est inaccessible pour le moment.", "La page n'a pas pu être chargée. Vérifiez l'adresse.",
    "La notice 12 n'existe plus.", "La ressource « ab » a été déplacée.", "Cette adresse n'a pas pu être chargée.", "Accès refusé au document 12.", "Votre session a expiré, veuillez vous reconnecter.",
    "Error 404: no se encontró la página solicitada.", "La página ya no existe.", "La página fue trasladada. Volver al inicio.", "La página devolvió el código 404.", "La página no está accesible ahora.", "La página no pudo cargarse. Revise la dirección.",
    "La ficha 12 ya no existe.", "La referencia «ab» fue trasladada.", "Esta dirección ya no existe.", "Acceso denegado al documento 12.", "Su sesión ha caducado; vuelva a iniciarla.", "El servicio no está disponible en este momento.",
)
_ASK = ("Enable", "Turn on", "Switch on", "Please allow", "You must activate", "You need to turn on", "We need you to permit")
_WHAT = ("JavaScript", "scripts", "scripting in your browser", "JS and cookies", "active scripting", "scripts and cookies")
_WHY = ("to read this item", "to see the references", "before the viewer can start", "and reload the page", "for this site; nothing is shown otherwise", "to open the full text")
SCRIPTS = tuple(f"{a} {b} {c}." for a, b, c in itertools.product(_ASK, _WHAT, _WHY)) + (
    "Your browser has scripting switched off.", "This reader requires JavaScript.", "JavaScript is disabled.", "Please enable JavaScript to view this document.", "Your browser is too old to run the viewer; update it or allow scripts.",
    "Bitte aktivieren Sie JavaScript, um das Dokument anzuzeigen.", "Bitte erlauben Sie Skripte im Browser, um fortzufahren.", "Bitte erlauben Sie aktive Inhalte und laden Sie die Seite neu.", "Zum Lesen benötigen Sie JavaScript und laden Sie die Seite neu.", "Schalten Sie JavaScript für diese Anzeige.", "Ohne Skripte kann dieser Text nicht dargestellt werden.",
    "Veuillez activer JavaScript pour afficher ce document.", "Autorisez les scripts puis rechargez la page.", "Activez le contenu actif dans votre navigateur.", "Il faut accepter JavaScript pour lire la notice.", "Cette page a besoin de scripts, qui sont bloqués par votre navigateur.",
    "Active JavaScript para ver este documento.", "Habilite los scripts para leer la ficha.", "Permita JavaScript en su navegador.", "Es necesario activar el contenido activo y recargue la página.", "El visor necesita que se permitan los scripts en su navegador.",
)

#: Sentences that only speak of such things or use such signs as notation: the rival of the models of residue.
SPOKEN = (
    "The printer filled the margin with lorem ipsum in the first edition, as the foreword tells.", "Access to the archive was denied to the first compilers, which explains the gap after 1950.",
    "A small JavaScript listing in the appendix enables the reader to repeat the count.", "The editor's manual asks authors to replace the mark [INSERT ABSTRACT HERE] before sending.",
    "A page was not found in the scan; its content is known from the second copy.", "Exactly 404 of the lattices were not found in the earlier census; the other 12 were.",
    "Error pages of three servers were removed before the graphs of links were counted.", "The error term of the estimate is at most 12 for trees of size 12.",
    "The template method, in which ${x}$ stands for any words, is due to an older note.", "Let \\frac{n}{k} be the ratio and let x_{i} run over the codes.", "Let \\frac{{n}}{{k}} be the ratio and let x_{{i}} run over the codes.",
    "The class {a} of singletons is written with double braces throughout, e.g. {x, y} for a pair.", 'The call printf("%s", row) prints one of the codes per line.',
    "In the given order the join of two elements may be undefined, and then we write null for its rank.",
)


def marks() -> list[str]:
    return list(PRINTED) * 8 + [f"{label}: {m % s}" if i % 3 else m % s for i, (label, m, s) in enumerate(itertools.product(LABELS, MARKS, SLOTS))]


def fillers() -> list[str]:
    words = sorted(LATIN)
    runs = [" ".join(words[(i * k) % len(words)] for k in range(7, 17)).capitalize() + "." for i in range(1, 400)]
    return [*runs, *FILLER * 12]
