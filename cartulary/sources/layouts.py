"""Source layouts: column order, types and the privacy treatment of each column."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Field:
    """One source column.

    `detail` names the document kind of a pseudonymised column (`cpf`, `nis`) or the
    generaliser of a generalised one (`zip5`, `age`).
    """

    source: str
    kind: str
    target: str
    category: str
    action: str
    detail: str = ""
    note: str = ""


@dataclass(frozen=True)
class Layout:
    name: str
    fields: tuple[Field, ...]

    @cached_property
    def names(self) -> list[str]:
        return [field.source for field in self.fields]

    @cached_property
    def raw_schema(self) -> StructType:
        return StructType([StructField(name, StringType()) for name in [*self.names, CORRUPT]])

    @classmethod
    def parse(cls, name: str, text: str) -> Layout:
        """Read lines of `source kind target category action [detail] [# note]`."""
        fields = []
        for line in filter(None, map(str.strip, text.splitlines())):
            spec, _, note = line.partition("#")
            source, kind, target, category, action, *detail = spec.split()
            fields.append(
                Field(
                    source,
                    kind,
                    source.lower() if target == "-" else target,
                    category,
                    action,
                    detail[0] if detail else "",
                    note.strip(),
                )
            )
        return cls(name, tuple(fields))


@dataclass(frozen=True)
class Feed:
    """Where a layout's files come from. `dated` feeds bring one snapshot per file name date."""

    layout: Layout
    pattern: str
    separator: str = ";"
    encoding: str = "UTF-8"
    dated: bool = True


# Column order, types, clean names and treatments of the official extracts.
FAMILY = Layout.parse(
    "cadunico_family",
    """
    CD_IBGE_CADASTRO                int   municipality_code            operational  keep
    CO_FAMILIAR_FAM                 str   family_id                    identifier   pseudonymize
    DT_CADASTRO_FAM                 date  registration_date            personal     keep
    DT_ATUALIZACAO_FAM              date  last_update_date             personal     keep
    CO_EST_CADASTRAL_FAM            int   registry_status              personal     keep  # 3 registered
    VL_RENDA_MEDIA_FAM              dec   reported_per_capita_income   personal     keep
    CO_MODALIDADE_OPER_FAM          int   -                            operational  drop
    CO_FORMA_COLETA_FAM             int   -                            operational  drop
    NO_LOCALIDADE_FAM               str   -                            identifier   drop
    NO_TIP_LOGRADOURO_FAM           str   -                            identifier   drop
    NO_TIT_LOGRADOURO_FAM           str   -                            identifier   drop
    NO_LOGRADOURO_FAM               str   -                            identifier   drop
    NU_LOGRADOURO_FAM               str   -                            identifier   drop
    DS_COMPLEMENTO_FAM              str   -                            identifier   drop
    DS_COMPLEMENTO_ADIC_FAM         str   -                            identifier   drop
    NU_CEP_LOGRADOURO_FAM           str   zip_prefix                   personal     generalize  zip5
    CO_UNIDADE_TERRITORIAL_FAM      str   -                            personal     drop
    NO_UNIDADE_TERRITORIAL_FAM      str   -                            personal     drop
    DS_REFERENCIA_LOCAL_FAM         str   -                            identifier   drop
    NO_ENTREVISTADOR_FAM            str   -                            identifier   drop
    NU_CPF_ENTREVISTADOR_FAM        str   -                            identifier   drop
    DS_OBS_ENTREVISTADOR_FAM        str   -                            identifier   drop
    IN_FAM_ALTERADA_V7              int   -                            operational  drop
    CO_LOCAL_DOMIC_FAM              int   area_type                    personal     keep
    CO_ESPECIE_DOMIC_FAM            int   dwelling_kind                personal     keep  # 2 improvised
    QT_COMODOS_DOMIC_FAM            int   rooms                        personal     keep
    QT_COMODOS_DORMITORIO_FAM       int   bedrooms                     personal     keep
    CO_MATERIAL_PISO_FAM            int   floor_material               personal     keep  # 1 dirt
    CO_MATERIAL_DOMIC_FAM           int   wall_material                personal     keep  # 5-8 makeshift
    CO_AGUA_CANALIZADA_FAM          int   piped_water                  personal     keep  # 2 no
    CO_ABASTE_AGUA_DOMIC_FAM        int   water_source                 personal     keep
    CO_BANHEIRO_DOMIC_FAM           int   has_bathroom                 personal     keep  # 2 no
    CO_ESCOA_SANITARIO_DOMIC_FAM    int   sewage_disposal              personal     keep  # 3-6 inadequate
    CO_DESTINO_LIXO_DOMIC_FAM       int   garbage_disposal             personal     keep  # 3-6 inadequate
    CO_ILUMINACAO_DOMIC_FAM         int   lighting                     personal     keep  # 4-6 not electric
    CO_CALCAMENTO_DOMIC_FAM         int   street_paving                personal     keep
    IN_FAMILIA_INDIGENA_FAM         int   is_indigenous                sensitive    keep
    CO_POVO_INDIGENA_FAM            int   -                            sensitive    drop
    NO_POVO_INDIGENA_FAM            str   -                            sensitive    drop
    CO_INDIGENA_RESIDE_FAM          int   -                            sensitive    drop
    CO_RESERVA_INDIGENA_FAM         int   -                            sensitive    drop
    NO_RESERVA_INDIGENA_FAM         str   -                            sensitive    drop
    IN_FAMILIA_QUILOMBOLA_FAM       int   is_quilombola                sensitive    keep
    CO_COMUNIDADE_QUILOMBOLA_FAM    int   -                            sensitive    drop
    NO_COMUNIDADE_QUILOMBOLA_FAM    str   -                            sensitive    drop
    QT_PESSOAS_DOMIC_FAM            int   people_in_dwelling           personal     keep
    QT_FAMILIAS_DOMIC_FAM           int   families_in_dwelling         personal     keep
    QT_PESSOA_INTER_0_17_ANOS_FAM   int   members_0_17                 personal     keep
    QT_PESSOA_INTER_18_59_ANOS_FAM  int   members_18_59                personal     keep
    QT_PESSOA_INTER_60_ANOS_FAM     int   members_60_plus              personal     keep
    VL_DESP_ENERGIA_FAM             dec   expense_energy               personal     keep
    VL_DESP_AGUA_ESGOTO_FAM         dec   expense_water_sewage         personal     keep
    VL_DESP_GAS_FAM                 dec   expense_gas                  personal     keep
    VL_DESP_ALIMENTACAO_FAM         dec   expense_food                 personal     keep
    VL_DESP_TRANSPOR_FAM            dec   expense_transport            personal     keep
    VL_DESP_ALUGUEL_FAM             dec   expense_rent                 personal     keep
    VL_DESP_MEDICAMENTOS_FAM        dec   expense_medicine             personal     keep
    NO_ESTAB_ASSIST_SAUDE_FAM       str   -                            sensitive    drop
    NU_ESTBO_SAUDE                  str   -                            sensitive    drop
    NO_CENTRO_ASSIST_FAM            str   -                            personal     drop
    CO_CENTRO_ASSIST_FAM            str   -                            personal     drop
    IN_PARC_MDS_FAM                 int   mds_partner_flag             personal     keep
    VL_RENDA_TOTAL_FAM              dec   total_income                 personal     keep
    QT_MEMBRO_FAMILIA               int   family_members               personal     keep
    CO_CTA_ENERG_UNID_CONSUM_FAM    str   -                            identifier   drop
    DS_MARC_BPC                     int   receives_bpc                 sensitive    keep
    """,
)

PERSON = Layout.parse(
    "cadunico_person",
    """
    CD_IBGE_CADASTRO           int   municipality_code     operational  keep
    CO_FAMILIAR_FAM            str   family_id             identifier   pseudonymize
    CO_CHV_NATURAL_PESSOA      str   person_id             identifier   pseudonymize
    DT_CADASTRAMENTO_MEMB      date  registration_date     personal     keep
    CO_EST_CADASTRAL_MEMB      int   registry_status       personal     keep
    NO_PESSOA                  str   -                     identifier   drop
    NU_NIS_PESSOA              str   nis_pseudo            identifier   pseudonymize  nis
    NO_APELIDO_PESSOA          str   -                     identifier   drop
    CO_SEXO_PESSOA             int   sex                   personal     keep
    DT_NASC_PESSOA             date  age                   personal     generalize    age
    CO_PARENTESCO_RF_PESSOA    int   relationship_to_head  personal     keep  # 1 head of family
    CO_RACA_COR_PESSOA         int   race_color            sensitive    keep
    NO_COMPLETO_MAE_PESSOA     str   -                     identifier   drop
    NO_COMPLETO_PAI_PESSOA     str   -                     identifier   drop
    NU_CPF_PESSOA              str   cpf_pseudo            identifier   pseudonymize  cpf
    NU_IDENTIDADE_PESSOA       str   -                     identifier   drop
    NU_TITULO_ELEITOR_PESSOA   str   -                     identifier   drop
    CO_DEFICIENCIA_MEMB        int   has_disability        sensitive    keep
    CO_SABE_LER_ESCREVER_MEMB  int   literate              personal     keep
    IN_FREQUENTA_ESCOLA_MEMB   int   attends_school        personal     keep
    CO_TRABALHOU_SEMANA_MEMB   int   worked_last_week      personal     keep
    CO_CART_ASSINADA_MEMB      int   formal_job            personal     keep
    IN_DORMIR_RUA_MEMB         int   sleeps_on_street      personal     keep
    DS_MARC_BPC                int   receives_bpc          sensitive    keep
    """,
)

CONTRACTS = Layout.parse(
    "mcmv_beneficiaries",
    """
    PROGRAMA             str   program            operational  keep
    NU_CPF_BENEFICIARIO  str   cpf_pseudo         identifier   pseudonymize  cpf
    NO_BENEFICIARIO      str   -                  identifier   drop
    DT_NASCIMENTO        date  age                personal     generalize    age
    VR_RENDA_FAMILIAR    dec   declared_income    personal     keep
    CO_MUNICIPIO_IBGE    int   municipality_code  operational  keep
    CO_CEP_IMOVEL        str   zip_prefix         personal     generalize    zip5
    DT_CONTRATACAO       date  contract_date      operational  keep
    CO_FAIXA_RENDA       int   income_band        operational  keep
    """,
)

MUNICIPALITIES = Layout.parse(
    "ref_municipalities",
    """
    CO_MUNICIPIO_IBGE  int  municipality_code  operational  keep
    NO_MUNICIPIO       str  municipality_name  operational  keep
    SG_UF              str  state              operational  keep
    CO_UF              int  state_code         operational  keep
    NO_REGIAO          str  region             operational  keep
    QT_POPULACAO       int  population         operational  keep
    QT_DOMICILIOS      int  households         operational  keep
    """,
)

DEFICIT = Layout.parse(
    "ref_fjp_deficit",
    """
    CO_MUNICIPIO_IBGE       int  municipality_code     operational  keep
    NU_ANO                  int  year                  operational  keep
    QT_DEFICIT_TOTAL        int  deficit_total         operational  keep
    QT_DEFICIT_PRECARIOS    int  deficit_precarious    operational  keep
    QT_DEFICIT_COABITACAO   int  deficit_cohabitation  operational  keep
    QT_DEFICIT_ONUS         int  deficit_rent_burden   operational  keep
    QT_DEFICIT_ADENSAMENTO  int  deficit_overcrowding  operational  keep
    """,
)

# File name patterns, encodings and cadence of the five feeds.
FEEDS = {
    "cadunico_family": Feed(FAMILY, "ARQ_FAMILIA_*.TXT", encoding="ISO-8859-1"),
    "cadunico_person": Feed(PERSON, "ARQ_PESSOA_*.TXT", encoding="ISO-8859-1"),
    "mcmv_beneficiaries": Feed(CONTRACTS, "BENEFICIARIOS_MCMV_*.csv"),
    "ref_municipalities": Feed(MUNICIPALITIES, "MUNICIPIOS.csv", dated=False),
    "ref_fjp_deficit": Feed(DEFICIT, "DEFICIT_FJP.csv", dated=False),
}
