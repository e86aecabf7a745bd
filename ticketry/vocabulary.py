"""Words that speak for or against a category, and the rules for ambiguous texts.

Matching runs on accent-free lower-case text, so terms are kept in that spelling. A term
the vocabulary knows in two spellings (with and without accents) counts twice; those are
named in ``TWO_SPELLINGS``.
"""

from __future__ import annotations

from typing import NamedTuple

# Categories, terms, weights and rules must read exactly like this.
CATEGORIES = ["ACC", "SW", "HW", "NET", "MAIL", "APP", "SRV", "POL"]
TIE_ORDER = ["ACC", "MAIL", "NET", "HW", "SW", "APP", "POL", "SRV"]
FALLBACK = "SRV"
WEIGHTS = {"base": 1.0, "boost": 1.5, "penalty": -1.0}

BASE_TERMS = {
    "ACC": [
        "login", "inicio de sesion", "iniciar sesion", "autenticacion", "sso", "mfa", "2fa",
        "contrasena", "restablecer contrasena", "cambiar contrasena", "olvide la contrasena",
        "cuenta bloqueada", "desbloquear cuenta", "permiso denegado", "acceso denegado",
        "credentials", "credenciales", "password", "reset password", "forgot password",
        "account locked", "access denied",
    ],
    "SW": [
        "instalar", "instalacion", "reinstalar", "actualizacion", "parche", "licencia",
        "serial", "driver", "software", "aplicacion de escritorio", "desinstalar", "update",
        "patch", "license", "product key", "desktop app", "uninstall", "upgrade", "downgrade",
        "bug", "error", "crash",
    ],
    "HW": [
        "hardware", "portatil", "laptop", "equipo", "pc", "teclado", "raton", "mouse",
        "monitor", "pantalla", "impresora", "scanner", "escaner", "webcam", "auriculares",
        "ssd", "disco", "bateria", "cargador", "charger", "dock", "docking station",
        "keyboard", "display", "printer", "headset", "battery",
    ],
    "NET": [
        "vpn", "wi fi", "wifi", "red", "conexion", "conectividad", "lan", "wan", "proxy",
        "dns", "ip", "gateway", "ping", "latencia", "perdida de paquetes", "cable de red",
        "ethernet", "switch", "router", "network", "connection", "connectivity",
        "packet loss", "no internet", "high latency",
    ],
    "MAIL": [
        "correo", "email", "buzon", "outlook", "exchange", "smtp", "imap", "pop3",
        "calendario", "meeting", "invite", "firma", "signature", "alias", "mailbox", "ndr",
        "bounce", "delivery failed", "o365", "microsoft 365",
    ],
    "APP": [
        "sap", "erp", "crm", "bpm", "salesforce", "dynamics", "navision", "sage", "jira",
        "confluence", "power bi", "sharepoint", "servicenow", "oracle", "oracle database",
        "oracle db", "workday", "netsuite", "odoo", "sccm", "webex", "intranet",
        "intranet corporativa", "portal interno", "intranet site", "sitio de intranet",
        "pagina de intranet",
    ],
    "SRV": [
        "alta", "baja", "solicito", "solicitud", "peticion", "permiso de acceso", "como hago",
        "manual", "procedimiento", "crear usuario", "dar de alta", "cambio planificado",
        "aprobar", "provisionar", "provision", "request", "new user", "onboarding",
        "offboarding", "how to", "grant access", "please provide", "standard change",
        "service request", "access to",
    ],
    "POL": [
        "antivirus", "phishing", "malware", "ransomware", "cifrado", "encriptado",
        "bloqueado por politica", "dlp", "firewall", "politica de seguridad", "seguridad",
        "quarantine", "blocked for security", "encryption", "security policy",
        "microsoft defender", "windows defender", "endpoint protection", "network policy",
        "policy",
    ],
}
TWO_SPELLINGS = {
    "autenticacion", "contrasena", "olvide la contrasena", "instalacion", "actualizacion",
    "aplicacion de escritorio", "portatil", "raton", "escaner", "bateria", "conexion",
    "perdida de paquetes", "buzon", "pagina de intranet", "peticion",
    "bloqueado por politica", "politica de seguridad",
}
BOOST_TERMS = {
    "ACC": [
        "active directory", "otp", "one time code", "codigo mfa", "codigo otp",
        "failed login", "invalid credentials",
    ],
    "MAIL": [
        "shared mailbox", "distribution list", "delegation", "ndr", "delivery failed",
        "auto-reply", "out of office",
    ],
    "NET": [
        "ip address", "dns server", "proxy auth", "802.1x", "ssid", "packet drop", "routing",
        "no internet access",
    ],
    "APP": [
        "sap gui", "s 4hana", "salesforce lightning", "dynamics 365", "sharepoint site",
        "jira project", "power bi dataset", "webex app", "configuration manager",
    ],
    "POL": [
        "blocked by policy", "security incident", "threat detected", "quarantined",
        "bitlocker", "filevault",
    ],
    "HW": [
        "battery not charging", "ac adapter", "power adapter", "keyboard not working",
        "screen flicker", "paper jam",
    ],
    "SW": [
        "deprecated", "obsolete feature", "missing license", "product activation",
        "runtime error", "dll",
    ],
    "SRV": ["grant access to", "please grant", "need access", "how do i", "procedure steps"],
}
PENALTY_TERMS = {
    "ACC": ["outlook", "imap", "smtp"],
    "MAIL": ["vpn", "dns", "proxy"],
    "NET": ["outlook", "mailbox"],
    "APP": ["printer", "monitor", "battery"],
    "HW": ["oracle", "sharepoint", "jira"],
    "SW": ["oracle", "sccm", "webex", "jira"],
    "POL": ["printer", "monitor"],
}
# Terms in which a dot stands for any character.
WILDCARD_TERMS = {"802.1x"}


class Term(NamedTuple):
    category: str
    kind: str
    term: str
    times: int = 1

    @property
    def weight(self) -> float:
        return WEIGHTS[self.kind] * self.times


class ContextRule(NamedTuple):
    """Any trigger, found anywhere in the text, lifts one category and lowers others."""

    triggers: list[str]
    prefer: str
    demote: list[str]
    boost: float
    force: bool = False


CONTEXT_RULES = [
    ContextRule(["outlook", "mailbox", "imap", "smtp", "email"], "MAIL", ["ACC"], 0.5),
    ContextRule(
        [
            "oracle", "oracle database", "sharepoint", "jira", "confluence", "power bi",
            "servicenow", "sccm", "webex", "intranet", "portal interno", "intranet site",
            "sitio de intranet", "página de intranet", "pagina de intranet",
        ],
        "APP", ["SW", "HW", "NET", "SRV"], 0.7,
    ),
    ContextRule(
        [
            "defender", "endpoint protection", "security policy", "network policy",
            "blocked by policy", "quarantine",
        ],
        "POL", ["NET", "SW"], 0.7,
    ),
    ContextRule(
        ["ip address", "dns", "vpn", "proxy", "router", "switch", "packet loss", "latency"],
        "NET", ["MAIL", "SRV"], 0.5,
    ),
]


def default_terms() -> list[Term]:
    """The whole vocabulary, one row per category, kind and term."""
    rows = []
    for kind, lists in (
        ("base", BASE_TERMS), ("boost", BOOST_TERMS), ("penalty", PENALTY_TERMS)
    ):
        for category, terms in lists.items():
            for term in terms:
                twice = kind == "base" and term in TWO_SPELLINGS
                rows.append(Term(category, kind, term, 2 if twice else 1))
    return rows
