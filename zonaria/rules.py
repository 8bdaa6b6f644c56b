"""Configuration of the land-regulation rules (fixed values of the domain)."""
from __future__ import annotations

from dataclasses import dataclass, field

LOCAL = ("PRC", "SECCIONAL", "LU")
INTERCOMUNAL = ("PRI", "PRM")
# Legal classes by priority: first the class, then the source that feeds it.
CLASS_ORDER = (
    ("U1", "SECCIONAL"), ("U1", "PRC"), ("U2", "LU"), ("U3", "PRI_U"), ("E", "PRI_E"), ("R1", "PRI_R"), ("R1", "PRI_ENV"),
)
CLASSES = ("U1", "U2", "U3", "E", "R1", "R2")
REMAINDER = ("R2", "SIN_IPT")


@dataclass(frozen=True)
class Rule:
    pattern: str
    kind: str
    default: str | None = None


@dataclass(frozen=True)
class LandRules:
    min_area: float = 1.0
    # Layer typing, in order of precedence.
    priority_layers: tuple[Rule, ...] = (
        Rule(r"(riesgo|patrimon|zona[_ ]?t[ií]pica|vialid)", "AFECTACION"),
        Rule(r"^PRMS_Resguardo", "AFECTACION"),
        Rule(r"l[ií]mites?[_ ]?urbanos?", "LU"),
    )
    services: tuple[Rule, ...] = (
        Rule(r"/IPT_AREA_RIESGO$", "AFECTACION"),
        Rule(r"/Patrimonio$", "AFECTACION"),
        Rule(r"/Limites_Urbanos$", "LU"),
        Rule(r"/PRDU_", "IGNORAR"),
        Rule(r"/PRC_Nuble$", "IGNORAR"),
        Rule(r"/PRI_Extension_urbana$", "PRI", "E"),
        Rule(r"/PRI_Area_Rural$", "PRI", "R"),
        Rule(r"/(PRMS|PRMC|PREMVAL)$", "PRM"),
        Rule(r"/PRI_", "PRI"),
    )
    layers: tuple[Rule, ...] = (
        Rule(r"(riesgo|patrimon|inund|remoci|tsunami|zona_?t[ií]pica|afecta|vialidad)", "AFECTACION"),
        Rule(r"((^|[_ \-])(ZNE|ICH|ZCH|AR)([_ \-]|$)|restricci)", "AFECTACION"),
        Rule(r"^(plano[_ ])?(seccional|ps)[_ ]", "SECCIONAL"),
        Rule(r"(l[ií]mite[_ ]?urbano|^lu[_ ])", "LU"),
        Rule(r"^(prms|prm|metropolitano)", "PRM"),
        Rule(r"^(pri|intercomunal)", "PRI"),
        Rule(r"^(prc|plan[_ ]regulador)", "PRC"),
    )
    overrides: dict[str, tuple[str, str | None]] = field(default_factory=lambda: {
        "IPT/PRC_Valparaíso/71": ("PRC", None),
        "IPT/PRC_Valparaíso/68": ("AFECTACION", None),
        "IPT/PRI_Valparaiso/6": ("PRI", "E"),
    })
    envelope: tuple[str, ...] = ("/PRI_Area_Rural/", r"/PRI_Araucan[ií]a/Unidad Territorial [A-Z]$")
    zone_fields: tuple[str, ...] = ("ZONA", "ZONIFICACION", "ZONIFICACI", "NOM_ZONA", "NOMBRE_ZONA", "ZONA_PRC",
                                    "COD_ZONA", "SIGLA", "CODIGO", "ZONAS", "NOMBRE")
    description_fields: tuple[str, ...] = ("DESCRIPCION", "DESCRIPCIO", "DESCRIP", "NOMBRE_ZONA", "NOM_ZONA", "USO",
                                           "USO_SUELO", "DETALLE", "OBS")
    comuna_fields: tuple[str, ...] = ("CUT", "CUT_COM", "COD_COMUNA", "COMUNA", "NOM_COMUNA", "NOM_COM", "NOMBRE_COM", "COM")
    layer_zone_field: dict[str, str] = field(default_factory=lambda: {"IPT/PRI_Valparaiso/6": "NOM"})
    cascade: tuple[tuple[str, str], ...] = (("ADMIN", "^MUNICIPALIDAD DE "), ("NOM", "^LIMITE URBANO DE "))
    aliases: dict[str, str] = field(default_factory=lambda: {
        "Pitufquén": "Pitrufquén", "Puerto Saavedra": "Saavedra", "Paiguano": "Paihuano", "Guaticas": "Guaitecas",
        "Entre Lagos": "Puyehue", "Llay Llay": "Llaillay", "Trehuaco": "Treguaco", "La Calera": "Calera",
        "Puerto Natales": "Natales",
    })
    risk: str = "RIESGO"
    risk_excluded: str = r"^APP\b"
    local_affectation: str = "/PRC_"
    zone_overrides: dict[str, str] = field(default_factory=lambda: {
        "Límite Urbano|Límite de Extensión Urbana": "E",
        "Límite Urbano|Límite Urbano Vigente": "U",
    })
    subclasses: tuple[tuple[str, str], ...] = (
        ("E", r"(EXTENSION|\bZEU|\bAEU|URBANIZABLE)"),
        ("R", r"(RURAL|SILVO|AGRO|AGRIC|PROTECCION|PRESERVACION|\bZR|\bAR\b|INTERES|VALOR NATURAL|RESTRICCION)"),
        ("U", r"(URBAN|CONSOLIDAD|\bZU|\bAU\b)"),
    )
