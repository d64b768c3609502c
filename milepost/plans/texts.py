"""Texts and codes that the review rules write, in rule order."""

VALID = "Válido"
EXPIRED = "Vencido"
UNSIGNED = "Não Assinado"
NOT_APPLICABLE = "Não se Aplica"

WORKS_RUNNING = "Em andamento"
WORKS_NOT_STARTED = "Não Iniciada"
WORKS_STOPPED = "Paralisada"

UNKNOWN_STATE = "Não informado"
CHECK_STATE = "Verificar"
OK_STATE = "OK"
NO_CONNECTION = "Sem Conexão"
NO_USAGE = "Sem Uso"

NO_LICENCE = "Sem LP"
LICENCE_UNKNOWN = "Não Informado"

SALE_BOTH = "Ambos"
SALE_REGULATED = "ACR"
SALE_NONE = "Nenhum"
SALE_PRIVATE = "ACL"

GRID_JUSTIFICATION = "Situação das obras de conexão e linha de transmissão associada."
ANALYSE_PREFIX = "Analisar"

SOURCE_HANDICAP = "Handicap"
SOURCE_FORECAST = "Data calculada"
SOURCE_OBLIGATION = "Obrigação"
SOURCE_OWNER = "Previsão do agente"
SOURCE_60_DAYS = "60 dias"
SOURCE_REVIEWER = "Análise do Fiscal"

# No rule applies.
NO_TEXT = "0"
NO_CRITERION = -8

# Worst detailed criterion of the plant -> justification.
JUSTIFICATIONS = {
    9.0: "Analisar justificativa: Revogação da outorga em avaliação ou Demandas judiciais ou "
    "Inviabilidade da implantação da usina",
    8.0: "Paralisação de obras",
    0.2: "Analisar justificativa: Sem Licença de Operação (LO) ou Alterações de características "
    "técnicas ou Estágio das obras da conexão associada ou Demandas judiciais ou Paralisação de "
    "obras",
    0.1: "Estágio das obras da usina",
    0.3: "Estágio das obras da usina",
    1.0: "Compromisso de venda de energia - PPA",
    2.0: "Acesso a rede contratado - CUST/CUSD",
    3.0: "Acesso a rede não contratado - CUST/CUSD",
    4.0: "Sem Licença de Instalação - LI",
    5.0: "Sem Licença de Instalação - LI",
    6.0: "Nenhuma licença ambiental válida",
    7.0: "Sem RAPEEL",
}

# Criterion of the plant -> description; criterion 0 depends on phase and test time.
DESCRIPTION_WORKS = "Usina em obras = Previsão OC maior entre data calculada e data RAPEEL"
DESCRIPTION_TEST_LONG = "Usina em Teste há mais de 30 dias = Previsão OC próximos 60 dias"
DESCRIPTION_TEST = "Usina em Teste = Previsão OC conforme data calculada"
DESCRIPTIONS = {
    9: "Usina Viabilidade Baixa análise da fiscalização",
    1: "Usina sem obras com PPA = Previsão OC maior entre data calculada, data RAPEEL e data "
    "compromisso",
    2: "Usina sem obras com CUST = Previsão OC maior entre data calculada, data RAPEEL e data "
    "compromisso",
    3: "Usina sem obras, sem cust, sem PPA e com LI = Previsão OC handicap de 5 anos",
    4: "Usina sem obras, com cust, sem PPA e sem LI = Previsão OC handicap de 5 anos",
    5: "Usina sem obras, sem cust, sem PPA e sem LI = Previsão OC handicap de 5 anos",
    7: "Usina sem obras, sem PPA e sem RAPEEL = Previsão OC handicap de 5 anos",
    6: "Usina sem LP = Previsão OC sem previsão",
    8: "Usina obras paralisadas = Previsão OC maior entre data RAPEEL e data compromisso",
}
