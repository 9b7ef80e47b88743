"""Public code lists and labels, stated as they are used elsewhere."""

#: System addresses of codes.
SYSTEM_CID10 = "http://hl7.org/fhir/sid/icd-10"
SYSTEM_SIGTAP = "http://sigtap.datasus.gov.br"
SYSTEM_IBGE = "http://ibge.gov.br/cidades"
SYSTEM_CBO = "http://cbo.mte.gov.br"
SYSTEM_CNES = "http://cnes.saude.gov.br"
SYSTEM_CPF = "http://rnds.saude.gov.br/fhir/r4/NamingSystem/cpf"

#: Chapters of the diagnosis classification: first and last category, description.
CHAPTERS = {
    "I": ("A00", "B99", "Algumas doenças infecciosas e parasitárias"),
    "II": ("C00", "D48", "Neoplasias (tumores)"),
    "III": ("D50", "D89", "Doenças do sangue e dos órgãos hematopoéticos"),
    "IV": ("E00", "E90", "Doenças endócrinas, nutricionais e metabólicas"),
    "V": ("F00", "F99", "Transtornos mentais e comportamentais"),
    "VI": ("G00", "G99", "Doenças do sistema nervoso"),
    "VII": ("H00", "H59", "Doenças do olho e anexos"),
    "VIII": ("H60", "H95", "Doenças do ouvido e da apófise mastóide"),
    "IX": ("I00", "I99", "Doenças do aparelho circulatório"),
    "X": ("J00", "J99", "Doenças do aparelho respiratório"),
    "XI": ("K00", "K93", "Doenças do aparelho digestivo"),
    "XII": ("L00", "L99", "Doenças da pele e do tecido subcutâneo"),
    "XIII": ("M00", "M99", "Doenças do sistema osteomuscular e do tecido conjuntivo"),
    "XIV": ("N00", "N99", "Doenças do aparelho geniturinário"),
    "XV": ("O00", "O99", "Gravidez, parto e puerpério"),
    "XVI": ("P00", "P96", "Algumas afecções originadas no período perinatal"),
    "XVII": ("Q00", "Q99", "Malformações congênitas, deformidades e anomalias cromossômicas"),
    "XVIII": ("R00", "R99", "Sintomas, sinais e achados anormais de exames clínicos e de laboratório"),
    "XIX": ("S00", "T98", "Lesões, envenenamento e algumas outras conseqüências de causas externas"),
    "XX": ("V01", "Y98", "Causas externas de morbidade e de mortalidade"),
    "XXI": ("Z00", "Z99", "Fatores que influenciam o estado de saúde e o contato com os serviços de saúde"),
}
NO_CHAPTER = "Não identificado"

#: Procedure groups by their first two digits.
PROCEDURE_GROUPS = {
    "01": "Ações de promoção e prevenção em saúde",
    "02": "Procedimentos com finalidade diagnóstica",
    "03": "Procedimentos clínicos",
    "04": "Procedimentos cirúrgicos",
    "05": "Transplantes de órgãos, tecidos e células",
    "06": "Medicamentos",
    "07": "Órteses, próteses e materiais especiais (OPM)",
    "08": "Ações complementares da atenção à saúde",
}

NO_GROUP = "Outros procedimentos"

#: State by the first two digits of a municipality code.
STATES = {
    "11": "RO",
    "12": "AC",
    "13": "AM",
    "14": "RR",
    "15": "PA",
    "16": "AP",
    "17": "TO",
    "21": "MA",
    "22": "PI",
    "23": "CE",
    "24": "RN",
    "25": "PB",
    "26": "PE",
    "27": "AL",
    "28": "SE",
    "29": "BA",
    "31": "MG",
    "32": "ES",
    "33": "RJ",
    "35": "SP",
    "41": "PR",
    "42": "SC",
    "43": "RS",
    "50": "MS",
    "51": "MT",
    "52": "GO",
    "53": "DF",
}

#: Names of the states by the same digits.
STATE_NAMES = {
    "11": "Rondônia",
    "12": "Acre",
    "13": "Amazonas",
    "14": "Roraima",
    "15": "Pará",
    "16": "Amapá",
    "17": "Tocantins",
    "21": "Maranhão",
    "22": "Piauí",
    "23": "Ceará",
    "24": "Rio Grande do Norte",
    "25": "Paraíba",
    "26": "Pernambuco",
    "27": "Alagoas",
    "28": "Sergipe",
    "29": "Bahia",
    "31": "Minas Gerais",
    "32": "Espírito Santo",
    "33": "Rio de Janeiro",
    "35": "São Paulo",
    "41": "Paraná",
    "42": "Santa Catarina",
    "43": "Rio Grande do Sul",
    "50": "Mato Grosso do Sul",
    "51": "Mato Grosso",
    "52": "Goiás",
    "53": "Distrito Federal",
}

#: Municipalities by six digits.
MUNICIPALITIES = {
    "120001": "Acrelândia",
    "120005": "Assis Brasil",
    "120010": "Brasiléia",
    "120013": "Bujari",
    "120017": "Capixaba",
    "120020": "Cruzeiro do Sul",
    "120025": "Epitaciolândia",
    "120030": "Feijó",
    "120032": "Jordão",
    "120033": "Mâncio Lima",
    "120034": "Manoel Urbano",
    "120035": "Marechal Thaumaturgo",
    "120038": "Plácido de Castro",
    "120039": "Porto Walter",
    "120040": "Rio Branco (Capital)",
    "120042": "Rodrigues Alves",
    "120043": "Santa Rosa do Purus",
    "120045": "Senador Guiomard",
    "120050": "Sena Madureira",
    "120060": "Tarauacá",
    "120070": "Xapuri",
    "120080": "Porto Acre",
}

#: Hospitals by facility code.
HOSPITALS = {
    "2001578": "Hospital de Clínicas do Acre (HC / Alta Complexidade)",
    "5336171": "Pronto-Socorro de Rio Branco (Huerb / Urgência e Trauma)",
    "2000733": "Maternidade Bárbara Heliodora (Saúde da Mulher / Neonatologia)",
    "2002078": "Hospital Regional do Alto Acre (Brasiléia)",
    "2001586": "Unidade Oncológica e Cuidados Paliativos (Unacon)",
    "2000725": "Hospital Regional do Juruá (Cruzeiro do Sul)",
    "2000296": "Hospital Dr. João Canuto (Tarauacá)",
    "2001500": "Hospital Sanson Pereira (Sena Madureira)",
    "2000121": "Hospital Municipal de Feijó",
    "2000865": "Hospital Municipal de Xapuri",
    "2001594": "Hospital Geral de Marechal Thaumaturgo",
    "2000172": "Hospital Geral de Manoel Urbano",
    "2000636": "Unidade Mista de Feijó",
}

#: Labels of diagnoses.
DIAGNOSES = {
    "I21.9": "Infarto Agudo do Miocárdio não especificado (IAM)",
    "I21": "Infarto Agudo do Miocárdio",
    "O80.0": "Parto Espontâneo Cefálico (Parto Normal)",
    "O80": "Parto Único Espontâneo",
    "O82.0": "Parto por Cesariana Eletiva",
    "O82.1": "Parto por Cesariana de Emergência",
    "O82": "Parto por Cesariana",
    "I64": "Acidente Vascular Cerebral (AVC Agudo não especificado)",
    "I63.8": "Outros Infartos Cerebrais (AVC Isquêmico)",
    "I63": "Infarto Cerebral (AVC Isquêmico)",
    "J18.9": "Pneumonia não especificada (Comunitária)",
    "J18.0": "Broncopneumonia não especificada",
    "J18": "Pneumonia por Microrganismo não especificado",
    "J15.9": "Pneumonia Bacteriana não especificada",
    "J15": "Pneumonia Bacteriana",
    "P07.3": "Prematuridade Extrema (Outros recém-nascidos pré-termo)",
    "P07": "Transtornos relacionados com a gestação de curta duração",
    "I20.0": "Angina Instável (Síndrome Coronariana Aguda)",
    "I20": "Angina Pectoris",
    "S12.2": "Fratura de Outras Vértebras Cervicais (Trauma Raquimedular)",
    "S12": "Fratura do Pescoço/Vértebras Cervicais",
    "K80.8": "Cálculo na Vesícula Biliar sem colecistite (Colelitíase)",
    "K80": "Colelitíase (Cálculos Biliares)",
    "K40.9": "Hérnia Inguinal Unilateral sem obstrução ou gangrena",
    "K40": "Hérnia Inguinal",
    "N18.9": "Doença Renal Crônica não especificada (Insuficiência Renal)",
    "N18": "Doença Renal Crônica",
    "A41.9": "Sepse não especificada (Choque Séptico / Infecção Generalizada)",
    "A41": "Outras Sepses",
    "T88.8": "Outras Complicações de Cuidados Médicos e Cirúrgicos",
    "T88.9": "Complicação não especificada de Cuidado Cirúrgico/Médico",
    "I50.9": "Insuficiência Cardíaca não especificada",
    "I50.0": "Insuficiência Cardíaca Congestiva (ICC)",
    "I50": "Insuficiência Cardíaca",
    "I10": "Hipertensão Essencial (Pressão Alta)",
    "I15.9": "Hipertensão Secundária não especificada",
    "A90": "Dengue Clássica",
    "A91": "Febre Hemorrágica devida ao vírus do Dengue (Dengue Grave)",
    "E11.9": "Diabetes Mellitus Tipo 2 sem complicações",
    "E11.8": "Diabetes Mellitus Tipo 2 com complicações não especificadas",
    "E10.9": "Diabetes Mellitus Tipo 1 sem complicações",
    "E10": "Diabetes Mellitus Tipo 1",
    "E11": "Diabetes Mellitus Tipo 2",
    "N39.0": "Infecção do Trato Urinário (ITU)",
    "K35.9": "Apendicite Aguda não especificada",
    "K35": "Apendicite Aguda",
    "K85.9": "Pancreatite Aguda não especificada",
    "K85": "Pancreatite Aguda",
    "K92.8": "Outras Afecções do Aparelho Digestivo (Hemorragia Digestiva)",
    "C53.9": "Neoplasia Maligna do Colo do Útero (Câncer de Colo Uterino)",
    "C53": "Neoplasia Maligna do Colo do Útero",
    "I42.2": "Outras Cardiomiopatias Hipertróficas (Cardiopatia Grave)",
    "D75.9": "Doença do Sangue e dos Órgãos Hematopoéticos não especificada",
    "S01.8": "Ferimento de Outras Partes da Cabeça (Trauma Craniofacial)",
    "O23.4": "Infecção não especificada do Trato Urinário na Gravidez",
    "F31.2": "Transtorno Afetivo Bipolar (Episódio Maníaco com Sintomas Psicóticos)",
    "A46": "Erisipela (Infecção Cutânea Aguda)",
    "N13.2": "Hidronefrose com Obstrução por Cálculo Renal",
    "N73.9": "Doença Inflamatória Pélvica Feminina não especificada",
    "A53.9": "Sífilis não especificada",
    "A49.9": "Infecção Bacteriana de Localização não especificada",
    "Z53.9": "Procedimento não Realizado por Motivo não especificado",
    "R02": "Gangrena não classificada em outra parte (Pé Diabético / Necrose)",
    "L98.8": "Outros Transtornos Especificados da Pele e Tecido Subcutâneo",
    "K59.8": "Outros Transtornos Funcionais do Intestino (Obstrução Intestinal)",
}

#: Labels of procedures.
PROCEDURES = {
    "0301060088": "Atendimento Médico em Unidade de Pronto Atendimento / Urgência",
    "0303010010": "Tratamento Clínico de Dengue",
    "0303010037": "Tratamento de Outras Doenças Infecciosas e Parasitárias",
    "0303010126": "Tratamento de Doenças Sexualmente Transmissíveis",
    "0303010142": "Tratamento de Meningites e Encefalites Virais",
    "0303020083": "Tratamento de Doenças do Sangue e Órgãos Hematopoéticos",
    "0303030038": "Tratamento Clínico de Diabetes Mellitus Descompensado",
    "0303040149": "Tratamento Clínico de Acidente Vascular Cerebral (AVC)",
    "0303060034": "Tratamento de Insuficiência Cardíaca e Cardiopatias Graves",
    "0303060107": "Tratamento Clínico de Crise Hipertensiva Grave",
    "0303070102": "Tratamento de Doenças do Aparelho Digestivo em Unidade Hospitalar",
    "0303070129": "Tratamento Clínico de Doenças do Pâncreas (Pancreatite)",
    "0303100044": "Tratamento de Infecção Urinária na Gestação",
    "0303150025": "Tratamento Clínico de Doenças Renais Agudas",
    "0303150033": "Tratamento Clínico de Doenças Ginecológicas Agudas",
    "0303150041": "Tratamento de Cólica Nefrética e Cálculo Renal",
    "0303150050": "Tratamento Clínico de Infecções Urinárias Altas / Pielonefrite",
    "0303160020": "Tratamento Intensivo / Semi-Intensivo de Recém-Nascido",
    "0303160039": "Tratamento de Prematuridade e Desconforto Respiratório Neonatal",
    "0303160063": "Ventilação Mecânica e Suporte Respiratório Neonatal",
    "0303170140": "Tratamento em Psiquiatria / Crise Psiquiátrica Aguda",
    "0304100021": "Tratamento Oncológico Clínico e Cuidados Paliativos",
    "0310010039": "Parto Normal Único sem Distócia",
    "0310010047": "Parto por Cesariana com Laqueadura Tubária",
    "0310010055": "Parto por Cesariana em Gestação de Alto Risco",
    "0401020053": "Desbridamento Cirúrgico de Tecidos Desvitalizados",
    "0407020101": "Laparotomia Exploradora Cirúrgica",
    "0407030026": "Apendicectomia Cirúrgica (Remoção do Apêndice)",
    "0407030034": "Colecistectomia Cirúrgica (Remoção da Vesícula Biliar)",
    "0407040102": "Herniorrafia Inguinal Cirúrgica (Correção de Hérnia)",
    "0408050080": "Tratamento Cirúrgico de Fratura / Redução e Fixação Óssea",
    "0415040035": "Cirurgia Reparadora e Tratamento de Feridas Complexas",
    "0201010010": "Exame Laboratorial / Coleta de Material Biológico",
    "0301010072": "Consulta Médica Especializada em Ambulatório (SIA)",
}

#: Reference population of municipalities.
POPULATION = {
    "120040": 419452,
    "120020": 89072,
    "120050": 46511,
    "120060": 43464,
    "120030": 35426,
    "120010": 26702,
    "120045": 23236,
    "120038": 19955,
    "120070": 19733,
    "120033": 19311,
    "120035": 17093,
    "120080": 18793,
    "120001": 15533,
    "120042": 19310,
    "120013": 12973,
    "120034": 9581,
    "120025": 18733,
    "120032": 9222,
    "120043": 6732,
    "120039": 12241,
    "120017": 10392,
    "120005": 7534,
}
NO_POPULATION = 30000

#: Columns with personal data, by source type.
PERSONAL = {
    "datasus_sih": ["NASC", "N_AIH", "CPF_AUT", "NOME_PAC"],
    "datasus_sia": ["AP_NASC", "AP_AUTORIZ", "AP_CNSPACS", "AP_CPF_AUT", "AP_CPF_SOL", "AP_PROF", "PA_AUTORIZ", "PA_CNSMED", "PA_NASC", "NOME_PAC"],
    "datasus_cnes": ["CPF_PROF", "NOME_PROF"],
    "datasus_sinan": ["DT_NASC", "NU_NOTIFIC", "NM_PACIENT", "CPF_PAC", "ID_CNS_SUS", "NUM_SUS", "NM_MAE_PAC", "CEP"],
    "datasus_sisab": ["NU_CPF_PROFISSIONAL", "CO_CNES", "CO_INE_EQUIPE"],
    "sisreg_regulation": ["ID_SOLICITACAO", "CNS_PACIENTE", "CPF_PACIENTE", "NM_PACIENTE", "DT_NASC", "CRM_SOLICITANTE", "CRM_REGULADOR"],
    "ans_data": ["CD_OPERADORA", "CNPJ_OPERADORA"],
    "fhir_patient": ["name", "identifier", "birthDate", "telecom", "address"],
    "fhir_synthetic": ["name_family", "name_given", "birthDate", "cpf", "raw_json"],
}
