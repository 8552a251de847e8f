"""Word lists and the ground lexicon table.

The word lists below are fixed values: extraction results depend on every
entry.  The lexicon itself is a small DataFrame
``(form, lemma, ground_type, ground_source, ground_reference_path)`` that the
extractor joins on, so a user may pass any other table of the same shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from likeness import schemas

QUALITY_ADJECTIVE = "quality_adjective"
SALIENT_VERB = "salient_verb"

# ---- fixed values: grounds, one "lemma: forms" line each --------------------
QUALITY_GROUNDS = """
forte: forte fortes
fraco: fraco fraca fracos fracas
leve: leve leves
pesado: pesado pesada pesados pesadas
grande: grande grandes
pequeno: pequeno pequena pequenos pequenas
rápido: rápido rápida rápidos rápidas
lento: lento lenta lentos lentas
duro: duro dura duros duras
mole: mole moles
frio: frio fria frios frias
quente: quente quentes
claro: claro clara claros claras
escuro: escuro escura escuros escuras
brilhante: brilhante brilhantes
cego: cego cega cegos cegas
livre: livre livres
preso: preso presa presos presas
frágil: frágil frágeis
seco: seco seca secos secas
doce: doce doces
amargo: amargo amarga amargos amargas
limpo: limpo limpa limpos limpas
sujo: sujo suja sujos sujas
alto: alto alta altos altas
baixo: baixo baixa baixos baixas
calmo: calmo calma calmos calmas
alegre: alegre alegres
triste: triste tristes
vazio: vazio vazia vazios vazias
cheio: cheio cheia cheios cheias
"""

VERB_GROUNDS = """
cair: cair caiu cai cairia
voar: voar voa voou voava
flutuar: flutuar flutua flutuou flutue
correr: correr corre correu corria
brilhar: brilhar brilha brilhou brilhava
trabalhar: trabalhar trabalha trabalhou trabalhava
encaixar: encaixar encaixa encaixou
caber: caber cabe coube
assentar: assentar assenta assentou
"""

# ---- fixed values: article pattern ------------------------------------------
ARTICLES = "um uma uns umas".split()

STRICT_BAD_STARTS = """
de do da dos das em no na nos nas o a os as ele ela eu me
todo toda todos todas é foi parece quando sempre só
""".split()

STRICT_GENERIC_HEADS = """
coisa forma tipo espécie parte meio processo exemplo tema
""".split()

ROLE_STEMS = """
usad utilizad conhecid tratad considerad definid classificad entendid
""".split()

CLEANUP_HEADS = """
luva bomba raio pedra rocha pluma touro flecha borboleta pássaro avião
""".split()

CLAUSE_STARTS = "é foi era fica tem deve ele ela isso".split()

# ---- fixed values: labelled pattern variants --------------------------------
STOP_TAIL_TOKENS = """
e ou mas que quando porque pois se eu tu ele ela nós nos vocês eles elas
me te lhe lhes é era foi será está estava tem tinha vai pode posso funciona
sempre também nunca
""".split()

VARIANT_BAD_STARTS = """
de do da dos das em no na nos nas o a os as um uma uns umas
todo toda todos todas meu minha meus minhas nosso nossa nossos nossas
seu sua seus suas este esta estes estas esse essa esses essas isso isto
aquele aquela aqueles aquelas se eu tu ele ela eles elas
você voce vocês voces me te lhe lhes é era foi será está estava
tem tinha vai pode posso funciona fosse foram eram são ser há ja já
agora antes depois quando como com para por mais menos demais
muitos muitas outros outras sempre também nunca só
""".split()

DEFINITE_ARTICLES = "o a os as".split()

ARTICLE_REJECT_HEADS = """
que qual quais mesmo mesma mesmos mesmas já ja próprio proprio própria propria
""".split()

VARIANT_GENERIC_HEADS = """
coisa forma tipo espécie parte meio processo exemplo tema
sistema profissional adulto
""".split()

COMPLEMENT_PREPOSITIONS = "de do da".split()

# ---- fixed values: head classification of bare candidates -------------------
ROLE_HEADS = """
administrador advogado aluno autor candidato chefe componente criminoso
dirigente empresário estratégia estudante exemplo ferramenta fornecedor
função gerente guerrilheiro jogador mandante operador parceiro polícia
produtor professor representante refém suspeito tendência
""".split()

VISUAL_HEADS = """
água breu chumbo cristal dia fogo luz mel mercúrio montanha ouro pedra
pluma raio sol vento vidro
""".split()

NON_NOMINAL_POS = "VERB AUX SCONJ ADP ADV PRON DET".split()
NOMINAL_POS = "NOUN PROPN".split()

# A small closed-class morphology table, "POS: form=lemma ..."; a user with a
# full morphological lexicon passes it as a DataFrame instead.
MORPHOLOGY = """
AUX: sendo=ser era=ser foi=ser é=ser são=ser ser=ser está=estar estava=estar
VERB: tem=ter tinha=ter vai=ir pode=poder faz=fazer disse=dizer parece=parecer
SCONJ: se=se porque=porque quando=quando que=que
ADP: de=de em=em para=para por=por com=com sem=sem sobre=sobre entre=entre
ADV: agora=agora antes=antes depois=depois mais=mais menos=menos nunca=nunca sempre=sempre também=também
PRON: eu=eu ele=ele ela=ela isso=isso isto=isto você=você ninguém=ninguém
DET: o=o a=o os=o as=o seu=seu sua=seu este=este esta=este
NOUN: gelo=gelo mel=mel pai=pai pedra=pedra cantor=cantor casas=casa jogadores=jogador gesto=gesto
PROPN: ayrton=ayrton
"""


def _groups(text: str) -> list[tuple[str, list[str]]]:
    lines = [line.split(":") for line in text.strip().splitlines()]
    return [(head.strip(), body.split()) for head, body in lines]


def ground_rows() -> list[tuple[str, str, str, str, str]]:
    """Rows of the built-in ground lexicon (135 forms, 40 lemmas)."""
    quality = [
        (form, lemma, QUALITY_ADJECTIVE, "curated_quality_list", "built-in")
        for lemma, forms in _groups(QUALITY_GROUNDS)
        for form in forms
    ]
    verbs = [
        (form, lemma, SALIENT_VERB, "curated_verb_list", "built-in")
        for lemma, forms in _groups(VERB_GROUNDS)
        for form in forms
    ]
    return quality + verbs


def ground_forms(ground_types: tuple[str, ...] = (QUALITY_ADJECTIVE, SALIENT_VERB)) -> list[str]:
    """Surface forms of the built-in lexicon for the given ground types."""
    return [form for form, _, kind, _, _ in ground_rows() if kind in ground_types]


def morphology_rows() -> list[tuple[str, str, str]]:
    """Rows ``(form, lemma, pos)`` of the built-in morphology table."""
    return [
        (*entry.split("="), pos) for pos, entries in _groups(MORPHOLOGY) for entry in entries
    ]


def values_table(
    spark: SparkSession, rows: list[tuple[str, ...]], columns: list[str]
) -> DataFrame:
    """A small table of text rows as an inline relation."""
    # An inline VALUES relation carries exact size statistics, so Catalyst
    # itself decides on broadcasting against its own threshold.
    quoted = ", ".join(
        "(" + ", ".join("'" + value.replace("'", "''") + "'" for value in row) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t({', '.join(columns)})")


def default_lexicon(spark: SparkSession) -> DataFrame:
    """The built-in ground lexicon as a DataFrame."""
    return values_table(spark, ground_rows(), schemas.columns(schemas.LEXICON))


def default_morphology(spark: SparkSession) -> DataFrame:
    """The built-in morphology table as a DataFrame."""
    return values_table(spark, morphology_rows(), schemas.columns(schemas.MORPHOLOGY))
