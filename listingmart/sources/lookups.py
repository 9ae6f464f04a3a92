"""Id -> label lookup lists (S7) and the fixed value maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOOKUP_ITEM = T.StructType([T.StructField("id", T.StringType()), T.StructField("label", T.StringType()),
                            T.StructField("name", T.StringType()), T.StructField("lang", T.StringType())])


def read_lookup(spark: SparkSession, path: str, result_key: str | None = None) -> DataFrame:
    """A landed lookup list (optionally nested under ``result_key``) -> (id, label, name, lang)."""
    if result_key:
        schema = T.StructType([T.StructField(result_key, T.ArrayType(LOOKUP_ITEM))])
        raw = spark.read.schema(schema).option("multiLine", True).json(path)
        return raw.select(F.inline(F.col(f"`{result_key}`")))
    return spark.read.schema(LOOKUP_ITEM).option("multiLine", True).json(path)


def lookup_from_text(df: DataFrame, text_col: str, result_key: str) -> DataFrame:
    """S7 on lookup responses held as JSON text (one response per row)."""
    schema = T.StructType([T.StructField(result_key, T.ArrayType(LOOKUP_ITEM))])
    return df.select(F.from_json(F.col(text_col), schema).alias("_r")).select(
        F.inline(F.col(f"_r.`{result_key}`")))


# Fixed values (must equal the reference's): the standardisation maps, as
# (source, field, old value, new value), in the order the reference lists them.
# Source A lists "Métiers Banque et Assurances" twice with the same target.
VALUE_MAPS = [
    ("A", "education_level", "TS Bac +2", "Bac +2"),
    ("A", "experience_years", "Moins D’un An", "<1 An"),
    ("A", "experience_years", "Sans Expérience", "<1 An"),
    ("A", "experience_years", "6 À 10 Ans", "5 À 10 Ans"),
    ("A", "experience_years", "Plus de 10 Ans", ">10 Ans"),
    ("A", "function", "Administration, Moyens Généraux", "Accueil, Administration - Services Généraux"),
    ("A", "function", "Autre", "Autres"),
    ("A", "function", "Education, Enseignement", "Education, Formation, Enseignement, Langues"),
    ("A", "function", "Métiers Banque et Assurances", "Banque, Bourse, Assurance"),
    ("A", "function", "Création, Design", "Création, Design, Médias Numériques"),
    ("A", "function", "Production, Méthode, Industrie",
     "Electrique et Électrotechnique, Industrie, Maintenance, Méthode, Production"),
    ("A", "function", "Informatique, Systèmes d'Information, Internet",
     "Analyse et Science des Données, Informatique, Internet, Systèmes d'Information"),
    ("A", "function", "Ingénierie, Etudes, Projet, R&D", "Bureau d'Études, Etudes, Ingénierie, Projet, R&D"),
    ("A", "function", "Marketing, Communication", "Commercial, Communication, Création, Marketing, RP"),
    ("A", "function", "Métiers de l'Agriculture", "Métiers de l'Agriculture, Nature"),
    ("A", "function", "Métiers Banque et Assurances", "Banque, Bourse, Assurance"),
    ("A", "function", "Santé, Médical, Pharmacie", "Santé, Médical, Pharmaceutique, Délégué Médical"),
    ("A", "function", "Logistique, Achat, Stock, Transport", "Achat, Emballage, Logistique, Stock, Transport"),
    ("A", "function", "Télécommunication, Réseaux", "Télécommunications, Systèmes, Réseaux"),
    ("A", "function", "Informatique, Télécommunication & Réseaux", "Télécommunications, Systèmes, Réseaux"),
    ("A", "contract_type", "Permanent Contract", "CDI"),
    ("A", "contract_type", "Fixed-term Contract", "CDD"),
    ("A", "contract_type", "Fixed-term Contract Or Mission", "CDD Ou Mission"),
    ("A", "contract_type", "Internship - Part Time", "Stage – Temps Partiel"),
    ("A", "contract_type", "Independent / Seasonal", "Indépendant/Saisonnier"),
    ("A", "work_mode", "onsite", "sur site"),
    ("A", "work_mode", "hybrid", "hybride"),
    ("B", "experience_years", "Moins de 1 An", "<1 An"),
    ("B", "experience_years", "Aucune Expérience", "<1 An"),
    ("B", "experience_years", "3 À 4 Ans", "3 À 5 Ans"),
    ("B", "experience_years", "4 À 5 Ans", "3 À 5 Ans"),
    ("B", "experience_years", "Plus de 10 Ans", ">10 Ans"),
    ("B", "education_level", "Secondaire", "Niveau Secondaire"),
    ("B", "education_level", "Bac", "Baccalauréat"),
    ("B", "education_level", "Bac +1", "Bac + 1"),
    ("B", "education_level", "Bac +2", "Bac + 2"),
    ("B", "education_level", "Bac +3", "Licence (LMD), Bac + 3"),
    ("B", "education_level", "Bac +4", "Master 1, Licence  Bac + 4"),
    ("B", "education_level", "Bac +5", "Master 2, Ingéniorat, Bac + 5"),
    ("B", "education_level", ">Bac +5", ">Bac + 5"),
    ("B", "contract_type", "Pre-emploi", "Pré-emploi"),
    ("B", "sector", "Construction BTP", "BTP, Construction, Immobilier"),
    ("B", "sector", "Immobilier", "BTP, Construction, Immobilier"),
    ("B", "sector", "service publics, Administrations", "Fonction Publique, Administration"),
    ("B", "sector", "Énergie, Mines, Matière première", "Energie, Mines, Matière Première"),
    ("B", "function", "Formation, Enseignement, Langues", "Education, Formation, Enseignement, Langues"),
    ("B", "function", "Industrie, Electrique et Électrotechnique, Production, Maintenance",
     "Electrique et Électrotechnique, Industrie, Maintenance, Méthode, Production"),
    ("B", "function", "Informatique, Systèmes d'Information, Analyse et Science des Données",
     "Analyse et Science des Données, Informatique, Internet, Systèmes d'Information"),
    ("B", "function", "Ingénierie, Bureau d'Études, Projet, R&D", "Bureau d'Études, Etudes, Ingénierie, Projet, R&D"),
    ("B", "function", "Juridique, Fiscal", "Audit, Conseil, Fiscal, Juridique"),
    ("B", "function", "Marketing, Communication, RP", "Commercial, Communication, Création, Marketing, RP"),
    ("B", "function", "Tourisme, Hôtellerie, Restauration", "Hôtellerie, Loisirs, Restauration, Tourisme"),
    ("B", "function", "Transport, Achat, Logistique, Emballage", "Achat, Emballage, Logistique, Stock, Transport"),
    ("B", "function", "Télécommunications, Systèmes, Réseau", "Télécommunications, Systèmes, Réseaux"),
    ("B", "function", "Ressources Humaines-Grh", "RH, Personnel, Formation"),
    ("B", "function", "Santé Hopital, Pharmaceutique", "Santé, Médical, Pharmaceutique, Délégué Médical"),
    ("B", "function", "Sport", "Sports"),
    ("B", "function", "Autres", "Autre"),
    ("B", "work_mode", "en partie depuis la maison", "hybride"),
    ("B", "work_mode", "la plupart depuis la maison", "hybride"),
    ("B", "work_mode", "100% depuis la maison", "remote"),
]

VALUE_MAP_SCHEMA = "source string, field string, old_value string, new_value string"


def value_map(source: str, field: str) -> dict[str, str]:
    """one field's map as a dict (duplicates with equal targets collapse)."""
    out: dict[str, str] = {}
    for s, f, old, new in VALUE_MAPS:
        if s == source and f == field:
            if old in out and out[old] != new:
                raise ValueError(f"conflicting targets for {old!r}")
            out[old] = new
    return out


def value_maps(source: str) -> dict[str, dict[str, str]]:
    fields = [f for s, f, _, _ in VALUE_MAPS if s == source]
    return {f: value_map(source, f) for f in dict.fromkeys(fields)}


def value_map_table(spark: SparkSession) -> DataFrame:
    """The maps as a table (source, field, old_value, new_value), distinct."""
    return spark.createDataFrame(VALUE_MAPS, VALUE_MAP_SCHEMA).distinct()
