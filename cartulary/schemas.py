"""Schemas of the tables that the jobs exchange.  Null tokens are never inferred; every reader states its types."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType

_MIX = (
    "mix_objectIdentifierValue string, mix_fileSize long, mix_dateTimeCreated string, mix_formatName string, mix_byteOrder string, "
    "mix_compressionScheme string, mix_imageWidth double, mix_imageHeight double, mix_xSamplingFrequency double, mix_ySamplingFrequency double, "
    "mix_samplingFrequencyUnit string, mix_colorSpace string, mix_scanningSoftwareName string, mix_formatVersion string"
)


_TYPES = {"string": StringType(), "long": LongType(), "bigint": LongType(), "int": IntegerType(), "double": DoubleType(), "boolean": BooleanType(), "map<string;string>": MapType(StringType(), StringType())}


def _struct(ddl: str) -> StructType:
    """A schema from "name type, ...", without a session."""
    return StructType([StructField(n, _TYPES[t]) for n, t in (f.strip().split(" ") for f in ddl.split(","))])


#: Disk inventory: one row per file of a snapshot; dates are epoch seconds.
INVENTORY = _struct("name string, path string, size long, checksum_md5 string, last_content_modification_date double, last_metadata_modification_date double")
#: File reference: the central table, one row per digitised file.
REFERENCE = _struct(
    "name string, path string, size long, last_content_modification_date double, last_metadata_modification_date double, checksum_md5 string, uuid string, "
    "extension string, file_type string, source2s3 string, conservation_statut string, finding_aid string, unitid string, osiros_id string, "
    f"{_MIX}, publication_statut string, corpus_code string, oai_set string, s3_key string, s3_uploaded boolean, s3_uploaded_date int, s3_bucket string"
)
MIX_COLUMNS = [f.name for f in _struct(_MIX)]
OBJECT_LISTING = _struct("key string, last_modified string, size long, storage_class string, uuid string, checksum_md5 string, s3_bucket string")
OAI_RECORDS = _struct("identifier string, cote string, title string, setname string, osiros_id string")
LINKS = _struct(
    "source string, ir string, finding_aid string, id_composant string, unitid string, profondeur int, role string, href string, href_base string, position string, taille_plage int"
)
ASSOCIATIONS = _struct("uuid string, name string, source string, finding_aid string, unitid string, methode string")
CONCORDANCE = _struct("ir string, unitid string, id string")
RECAP = _struct(
    "source string, source_format string, source_taille_octets long, source_largeur_px int, source_hauteur_px int, fichier string, format string, "
    "qualite int, taille_octets long, largeur_px int, hauteur_px int"
)
#: Recap of conversions that aim at a compression ratio; never mixed with RECAP.
RATIO_RECAP = _struct(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RECAP) + ", ratio_cible double, ratio_obtenu double, iterations int")
TECHNICAL = _struct(
    "jhove_uri string, jhove_lastModified string, jhove_format string, jhove_version string, jhove_mimeType string, jhove_size long, jhove_imageWidth int, "
    "jhove_imageHeight int, jhove_samplingFrequencyUnit string, jhove_x_resolution double, jhove_y_resolution double"
)
#: An XML document as rows in document order.
NODES = _struct(
    "doc string, node_id int, parent_id int, ord int, depth int, tag string, attrs map<string;string>, text string, tail string, comp_id int, comp_depth int, last_id int, inner string"
)
TRANSFER_LOG = _struct("name string, path string, checksum_md5 string, uuid string, size long, key string, uploaded boolean, uploaded_file_size long, uploaded_file_lastmodified string, error string")
COPY_LOG = _struct("corpus_code string, name string, statut string, src string, dst string, erreur string")
