"""From raw layers to typed, homologated features."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..rules import INTERCOMUNAL, LOCAL, LandRules

NO_CASE = "(?iu)"


def _first_match(subject: Column, rules, pick) -> Column:
    expr = None
    for rule in rules:
        condition = subject.rlike(NO_CASE + rule.pattern)
        value = F.lit(pick(rule)).cast("string")
        expr = F.when(condition, value) if expr is None else expr.when(condition, value)
    return expr


def type_layers(catalogue: DataFrame, rules: LandRules = LandRules()) -> DataFrame:
    """Adds ``tipo`` and ``pri_default`` to a catalogue(service, layer_id, layer_name)."""
    key = F.concat_ws("/", "service", F.col("layer_id").cast("string"))
    pairs = [F.lit(v) for k, (kind, _) in rules.overrides.items() for v in (k, kind)]
    manual = F.try_element_at(F.create_map(*pairs), key) if pairs else F.lit(None).cast("string")
    defaults = [F.lit(v) for k, (_, d) in rules.overrides.items() if d for v in (k, d)]
    manual_default = F.try_element_at(F.create_map(*defaults), key) if defaults else F.lit(None).cast("string")
    service = _first_match(F.col("service"), rules.services, lambda r: r.kind)
    service_default = _first_match(F.col("service"), rules.services, lambda r: r.default)
    priority = _first_match(F.col("layer_name"), rules.priority_layers, lambda r: r.kind)
    layer = _first_match(F.col("layer_name"), rules.layers, lambda r: r.kind)
    ignored = F.coalesce(service == "IGNORAR", F.lit(False))
    kind = (F.when(manual.isNotNull(), manual).when(ignored, "IGNORAR").when(priority.isNotNull(), priority)
            .when(service.isNotNull(), service).otherwise(F.coalesce(layer, F.lit("IGNORAR"))))
    default = (F.when(manual.isNotNull(), manual_default).when(ignored | priority.isNotNull(), F.lit(None))
               .when(service.isNotNull(), service_default))
    return catalogue.withColumns({"tipo": kind, "pri_default": default.cast("string")})


def dedupe_catalogue(catalogue: DataFrame) -> DataFrame:
    """One entry per (service, layer_name); a map service wins over a feature service."""
    rest = [c for c in catalogue.columns if c not in ("service", "layer_name")]
    order = F.struct((F.col("service_type") != "MapServer").alias("a"), F.col("layer_id"))
    best = catalogue.groupBy("service", "layer_name").agg(F.min_by(F.struct(*rest), order).alias("b"))
    return best.select("service", "layer_name", *[F.col(f"b.{c}").alias(c) for c in rest]).select(*catalogue.columns)


def typed_layers(catalogue: DataFrame, rules: LandRules = LandRules()) -> DataFrame:
    """The different (service, layer_id, layer_name) of a catalogue with their type and the number of their rows (``n``): the
    rules are tried once for each, not once for each row."""
    layers = catalogue.groupBy("service", "layer_id", "layer_name").agg(F.count("*").alias("n"))
    return type_layers(layers, rules)


def type_counts(catalogue: DataFrame) -> DataFrame:
    """Rows of each type; a catalogue with ``n`` says of how many rows each of its own stands."""
    rows = F.sum("n") if "n" in catalogue.columns else F.count("*")
    return catalogue.groupBy("tipo").agg(rows.alias("capas"))


def extent_overlaps(catalogue: DataFrame, selection: DataFrame) -> DataFrame:
    """Catalogue entries whose service extent meets the selected box of the same spatial reference; an entry
    without an extent or with an unknown reference stays. ``selection(wkid, xmin, ymin, xmax, ymax)``: one box per reference."""
    e, s = F.col("c.service_extent"), F.col("s.b")
    boxes = selection.select("wkid", F.struct("xmin", "ymin", "xmax", "ymax").alias("b"))
    joined = catalogue.alias("c").join(boxes.alias("s"), F.col("c.service_wkid") == F.col("s.wkid"), "left")
    meets = (e["xmin"] <= s["xmax"]) & (e["xmax"] >= s["xmin"]) & (e["ymin"] <= s["ymax"]) & (e["ymax"] >= s["ymin"])
    return joined.where(F.coalesce(meets, F.lit(True))).select("c.*")


def select_layers(catalogue: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries asked for, keys asked for that do not exist); ``wanted(key)``, key = service/layer_id."""
    keyed = catalogue.withColumn("key", F.concat_ws("/", "service", F.col("layer_id").cast("string")))
    return keyed.join(wanted, "key", "left_semi"), wanted.join(keyed.select("key"), "key", "left_anti").distinct()


def cached_counts(catalogue: DataFrame, features: DataFrame) -> DataFrame:
    """Number of cached features per layer; null where nothing is cached."""
    counts = features.groupBy("service", "layer_id").agg(F.count("*").alias("features"))
    return catalogue.join(counts, ["service", "layer_id"], "left")


def pick_field(keys: Column, candidates: tuple[str, ...], excluded: Column | None = None) -> Column:
    """First candidate that a layer has, in any case (the spelling of the layer is returned)."""
    def spelled(name: str) -> Column:
        return F.get(F.filter(keys, lambda k: F.upper(k) == name), F.lit(0))

    found = [spelled(name) for name in candidates]
    if excluded is not None:
        found = [F.when(f.eqNullSafe(excluded), F.lit(None)).otherwise(f) for f in found]
    return F.coalesce(*found)


def layer_fields(raw: DataFrame, rules: LandRules = LandRules()) -> DataFrame:
    """The zone, description and comuna fields of every layer, chosen by presence."""
    keys = (raw.select("service", "layer_id", F.explode(F.map_keys("properties")).alias("k")).distinct()
            .groupBy("service", "layer_id").agg(F.array_sort(F.collect_list("k")).alias("keys")))
    layer_key = F.concat_ws("/", "service", F.col("layer_id").cast("string"))
    pairs = [F.lit(v) for pair in rules.layer_zone_field.items() for v in pair]
    special = F.try_element_at(F.create_map(*pairs), layer_key) if pairs else F.lit(None).cast("string")
    special = F.when(F.array_contains("keys", special), special)
    zoned = keys.withColumn("zone_field", F.coalesce(special, pick_field(F.col("keys"), rules.zone_fields)))
    return zoned.withColumns({
        "description_field": pick_field(F.col("keys"), rules.description_fields, F.col("zone_field")),
        "comuna_field": pick_field(F.col("keys"), rules.comuna_fields),
    }).drop("keys")


def sub_class(zone: Column, description: Column, rules: LandRules = LandRules()) -> Column:
    return _sub_class(F.concat_ws(" ", X.norm_text(zone), X.norm_text(description)), rules)


def _sub_class(text: Column, rules: LandRules) -> Column:
    expr = None
    for name, pattern in rules.subclasses:
        expr = F.when(text.rlike(pattern), name) if expr is None else expr.when(text.rlike(pattern), name)
    return expr


def is_envelope(service: Column, layer: Column, rules: LandRules = LandRules()) -> Column:
    key = F.concat_ws("/", service, layer)
    return F.greatest(*[key.rlike(NO_CASE + p) for p in rules.envelope])


def is_local(kind: Column, service: Column, layer: Column, rules: LandRules = LandRules()) -> Column:
    return kind.isin(*LOCAL) | ((kind == "AFECTACION") & F.concat_ws("/", service, layer).rlike(rules.local_affectation))


def is_risk(layer: Column, zone: Column, description: Column, rules: LandRules = LandRules()) -> Column:
    return _is_risk(X.norm_text(layer), X.norm_text(zone), X.norm_text(description), rules)


def _is_risk(layer: Column, zone: Column, description: Column, rules: LandRules) -> Column:
    return (layer.rlike(rules.risk) | F.concat_ws(" ", zone, description).rlike(rules.risk)) & ~zone.rlike(rules.risk_excluded)


def zone_key(name: Column, zone: Column) -> Column:
    return F.concat_ws("|", X.norm_text(name), X.norm_text(zone))


def source_fields(df: DataFrame, rules: LandRules = LandRules()) -> DataFrame:
    """Adds fuente, revisar, rango and riesgo to features(tipo, pri_default, servicio, capa, ipt_nombre, zona, zona_desc)."""
    # Every key is made once, as a column, and used by all rules.
    df = df.withColumns({"_capa": X.norm_text(F.col("capa")), "_zona": X.norm_text(F.col("zona")), "_desc": X.norm_text(F.col("zona_desc"))})
    sub = _sub_class(F.concat_ws(" ", "_zona", "_desc"), rules)
    inter = F.col("tipo").isin(*INTERCOMUNAL)
    default = F.col("pri_default")
    envelope = is_envelope(F.col("servicio"), F.col("capa"), rules)
    df = df.withColumns({"_sub": sub, "_env": inter & envelope, "riesgo": _is_risk(F.col("_capa"), F.col("_zona"), F.col("_desc"), rules)})
    fuente = (F.when(F.col("_env"), "PRI_ENV").when(inter, F.concat(F.lit("PRI_"), F.coalesce("_sub", default, F.lit("R"))))
              .otherwise(F.col("tipo")))
    ranked_risk = F.col("riesgo") & (F.col("tipo") != "AFECTACION") & ~F.col("_env")
    rango = (F.when(F.col("_env"), 4).when(ranked_risk, 3).when(~inter | F.col("_sub").isNotNull(), 0)
             .when(default.isNotNull(), 2).otherwise(1))
    revisar = inter & ~F.col("_env") & ~ranked_risk & F.col("_sub").isNull() & default.isNull()
    df = df.withColumns({"fuente": fuente, "rango": rango, "revisar": revisar})
    if rules.zone_overrides:
        pairs = []
        for key, value in rules.zone_overrides.items():
            name, zone = key.split("|", 1)
            pairs += [zone_key(F.lit(name), F.lit(zone)), F.lit(value)]
        manual = F.try_element_at(F.create_map(*pairs), F.concat_ws("|", X.norm_text(F.col("ipt_nombre")), "_zona"))
        df = df.withColumn("_manual", manual)
        applies = (F.col("_manual") == "AFECTACION") | (F.col("_manual").isNotNull() & inter)
        applies = F.coalesce(applies, F.lit(False))
        df = df.withColumns({
            "fuente": F.when(applies & (F.col("_manual") == "AFECTACION"), "AFECTACION")
            .when(applies, F.concat(F.lit("PRI_"), "_manual")).otherwise(F.col("fuente")),
            "rango": F.when(applies & (F.col("_manual") != "AFECTACION"), 0).otherwise(F.col("rango")),
            "revisar": F.col("revisar") & ~applies,
        }).drop("_manual")
    return df.drop("_sub", "_env", "_capa", "_zona", "_desc")


def split_affectations(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(partition, affectations): risk zones are in both; affectation layers and overrides only in the second."""
    outside = F.col("fuente") == "AFECTACION"
    return features.where(~outside), features.where(outside | F.col("riesgo"))


def comuna_lookup(names: DataFrame, comunas: DataFrame, value: str) -> DataFrame:
    """Distinct free texts → comuna: digits as a code, otherwise the longest leading words that name a comuna.

    ``names`` has the column ``value``; result ``(value, cut)`` only for the texts that resolve.
    """
    texts = names.select(F.col(value).alias("value")).where(F.col("value").isNotNull()).distinct()
    trimmed = F.trim("value")
    digits = trimmed.rlike(r"^\d+$")
    codes = texts.where(digits).select("value", F.explode(F.array_distinct(F.array(
        F.struct(F.lit(0).alias("o"), F.when(F.length(trimmed) < 5, F.lpad(trimmed, 5, "0")).otherwise(trimmed).alias("cut")),
        F.struct(F.lit(1).alias("o"), trimmed.alias("cut"))))).alias("c")).select("value", "c.o", "c.cut")
    by_code = (codes.join(comunas.select("cut"), "cut").groupBy("value").agg(F.min_by("cut", "o").alias("cut")))
    words = F.filter(F.split(X.norm_text(F.col("value")), " "), lambda w: w != "")
    heads = (texts.where(~digits).withColumn("w", words).where(F.size("w") > 0)
             .select("value", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("n"), "w")
             .select("value", "n", F.array_join(F.slice("w", F.lit(1), F.col("n")), " ").alias("head")))
    named = comunas.groupBy(X.norm_text(F.col("comuna")).alias("head")).agg(F.max("cut").alias("cut"))
    by_name = heads.join(named, "head").groupBy("value").agg(F.max_by("cut", "n").alias("cut"))
    return by_code.unionByName(by_name)


def cascade_values(props: Column, comuna_field: Column, keys: Column, layer_name: Column, rules: LandRules = LandRules()) -> Column:
    """Texts that may name the comuna of a feature, in order of trust: array of struct(o, v)."""
    values = [F.try_element_at(props, comuna_field)]
    for name, prefix in rules.cascade:
        fld = pick_field(keys, (name,))
        text = X.norm_text(F.try_element_at(props, fld))
        values.append(F.when(text.rlike(prefix), F.regexp_replace(text, prefix, "")))
    alias_pairs = [v for k, a in rules.aliases.items() for v in (X.norm_text(F.lit(k)), F.lit(a))]
    aliases = [F.try_element_at(F.create_map(*alias_pairs), X.norm_text(v)) for v in values] if alias_pairs else []
    ordered = [*values, *aliases, layer_name]
    structs = [F.struct(F.lit(i).alias("o"), v.alias("v")) for i, v in enumerate(ordered)]
    return F.filter(F.array(*structs), lambda s: X.norm_text(s["v"]) != "")


def resolve_comuna(features: DataFrame, comunas: DataFrame, rules: LandRules = LandRules()) -> DataFrame:
    """Adds ``cut_ipt`` to features(fid, properties, comuna_field, layer text ``ipt_nombre``) by the cascade."""
    keys = F.map_keys("properties")
    candidates = features.select("fid", F.explode(cascade_values(
        F.col("properties"), F.col("comuna_field"), keys, F.col("ipt_nombre"), rules)).alias("c")).select("fid", "c.o", "c.v")
    lookup = comuna_lookup(candidates, comunas, "v")
    best = (candidates.join(lookup.withColumnRenamed("value", "v"), "v").groupBy("fid").agg(F.min_by("cut", "o").alias("cut_ipt")))
    return features.join(best, "fid", "left")


def homologate(raw: DataFrame, catalogue: DataFrame, comunas: DataFrame, rules: LandRules = LandRules()) -> DataFrame:
    """raw(fid, service, layer_id, properties, geom) ⋈ typed catalogue → normalised features."""
    entries = catalogue.select("service", "layer_id", "layer_name", "tipo", "pri_default", "url")
    joined = (raw.join(layer_fields(raw, rules), ["service", "layer_id"], "left").join(entries, ["service", "layer_id"])
              .where(F.col("tipo") != "IGNORAR"))
    base = joined.select(
        "fid", "properties", "comuna_field", "tipo", "pri_default",
        X.instrument_name(F.col("layer_name")).alias("ipt_nombre"), F.col("service").alias("servicio"),
        F.col("layer_name").alias("capa"),
        X.clean(F.try_element_at("properties", F.col("zone_field"))).alias("zona"),
        X.clean(F.try_element_at("properties", F.col("description_field"))).alias("zona_desc"),
        F.to_json("properties").alias("attrs_raw"), F.col("url").alias("fuente_url"), "geom")
    base = base.withColumn("comunal", is_local(F.col("tipo"), F.col("servicio"), F.col("capa"), rules))
    resolved = resolve_comuna(base, comunas, rules)
    resolved = resolved.withColumn("cut_ipt", F.when(F.col("comunal"), F.col("cut_ipt")))
    names = comunas.select(F.col("cut").alias("cut_ipt"), F.col("comuna").alias("_n"))
    named = resolved.join(names, "cut_ipt", "left").withColumn("ipt_nombre", F.when(
        F.col("tipo") == "LU", F.trim(F.concat(F.lit("Límite Urbano "), F.coalesce("_n", F.lit(""))))).otherwise(F.col("ipt_nombre")))
    return source_fields(named.drop("_n", "properties", "comuna_field"), rules).withColumnRenamed("tipo", "ipt_tipo")
