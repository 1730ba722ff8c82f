"""Codes, limits and report texts that the findings must carry as they are."""

# --- Fixed values: phase codes (A=4, B=2, C=1) and what follows from them -------------------
PHASE_LETTERS = {4: "A", 2: "B", 1: "C", 5: "AC", 6: "AB", 3: "BC", 7: "ABC"}
PHASE_COUNT = {1: 1, 2: 1, 4: 1, 3: 2, 5: 2, 6: 2, 7: 3}
FEEDER_INFO = {4: 1, 2: 2, 1: 4, 6: 3, 3: 6, 5: 5, 7: 7}

# --- Fixed values: phases implied by a subtype ----------------------------------------------
MEDIUM_VOLTAGE_PHASES = {1: 1, 4: 1, 2: 2, 5: 2, 3: 3, 6: 3}
LOW_VOLTAGE_PHASES = {1: 1, 4: 1, 7: 1, 2: 2, 5: 2, 8: 2, 3: 3, 6: 3, 9: 3}
TRANSFORMER_PHASES = {1: 1, 2: 1, 3: 1, 4: 1, 9: 2, 10: 2, 13: 2, 5: 3, 6: 3, 7: 3, 8: 3, 11: 3, 12: 3}

# --- Fixed values: transformer subtypes -----------------------------------------------------
TRANSFORMER_UNITS = {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 13: 1, 9: 2, 10: 2, 11: 3, 12: 3}
TRANSFORMER_GROUP = {
    1: "Monofasico",
    2: "Monofasico",
    3: "Monofasico",
    4: "Monofasico",
    13: "Bifasico",
    5: "Trifasico",
    6: "Trifasico",
    7: "Trifasico",
    8: "Trifasico",
    9: "Banco 2 Transformadores",
    10: "Banco 2 Transformadores",
    11: "Banco 3 Transformadores",
    12: "Banco 3 Transformadores",
}
BANK_SUBTYPES = [9, 10, 11, 12]

# --- Fixed values: limits and codes of the checks -------------------------------------------
SINGLE_PHASE_VOLTAGE = 7960
MULTI_PHASE_VOLTAGE = 13800
NO_NEUTRAL = "COO0000"
TAP_RANGE = (1, 5)
SWITCH_STRUCTURE_LETTER = {1: "S", 2: "D", 3: "E"}
TOTALIZER_LOAD = 1
MEDIUM_VOLTAGE_LOAD = 6
PUBLIC_PROJECT = "FOPE"
CONNECTION_STATES = {"Activos": "A", "Gestion Comercial": "1", "Inactivo": "W"}
CENSUS_OWNER = "SIGELEC"
CENSUS_COLUMN = "ORDENTRABAJO"
CENSUS_EXCLUDED = "^[A|D][0-9]"
CENSUS_VIEW = "V_ORDENES_SIG"

# --- Fixed values: categories and titles of the rules ---------------------------------------
RULE_TITLES = {
    "R01": ("ADMS", "Fase de conexion con el Subtipo asignado"),
    "R02": ("ADMS", "Fase de Conexión del Feature con el Trafo relacionado"),
    "R03": ("EFM", "Errores del Feeder INFO y Lado Baja TR"),
    "R04": ("EFM", "Elementos de BT que tienen el ParentCircuitSource del Disyuntor y no el de un Transformador"),
    "R05": ("ADMS", "Fase de conexion, Voltaje, Codigo de Estructura y Corriente"),
    "R06": ("ADMS", "Cantidad de unidades (tabla relacional) de acuerdo a la Fase Conexión"),
    "R07": ("ADMS", "Capacidad en Unidad Fusible con valor NULL"),
    "R08": ("ADMS", "Cantidad de Unidades (tabla relacional) de acuerdo a la Fase Conexión"),
    "R09": ("ADMS", "Suma de Potencia en tabla relacional igual a la Potencia del Puesto"),
    "R10": ("ADMS", "Codigo de Estructura, Configuracion de conductores y Secuencia de Fase"),
    "R11": ("ADMS", "Codigo Estructura, Fase de Conexion, Voltaje y Configuración de Conductores"),
    "R12": ("ADMS", "Corriente, Corriente Máxima, Fase Conexion y Voltaje con valor NULL"),
    "R13": ("ADMS", "Número de Taps y Configuración Lado Baja-Media"),
    "R14": ("ADMS", "Cantidad de Unidades (tabla relacional) de acuerdo al Subtipo del Transformador"),
    "R15": ("ADMS", "Fase de Conexión del Puesto y la Unidad deben coincidir"),
    "R16": ("ADMS", "Fase Conexión del Puesto y la Unidad para Banco Transformador"),
    "R17": ("ADMS", "Suma de Potencia en tabla relacional igual a la Potencia del Puesto"),
    "R18": ("ADMS", "Cuentas Repetidas"),
    "R19": ("ADMS", "Cuentas Repetidas"),
    "R20": ("ADMS", "Con Código de Cliente y sin Número de Medidor en AtributosConsumidor"),
    "R21": ("ADMS", "Sin Código de Cliente en Conexion Consumidor"),
    "R22": ("ADMS", "Sin Código de Cliente y sin Número de Medidor en Conexion Consumidor"),
    "R23": ("CIM", "Conexion Consumidor no tiene CODIGOUNICO especificado y su NOVEDAD es [0]"),
}

# --- Fixed values: detail texts -------------------------------------------------------------
COUNT_BY_PHASE = "Cantidad por Fase Conexion: "
COUNT_BY_SUBTYPE = "Cantidad por Subtipo: "
COUNT_OF_UNITS = "Cantidad en Unidad Fusible: "
CLIENT_PHASE = "FaseCliente="
TRANSFORMER_PHASE = "FaseTrafo="
VOLTAGE_SINGLE = "Voltaje incorrecto es Monofásico"
VOLTAGE_MULTI = "Voltaje incorrecto es Bifásico o Trifásico"
STRUCTURE_PHASES = {
    1: "Codigo estructura incorrecto es Monofásico",
    2: "Codigo estructura incorrecto es Bifásico",
    3: "Codigo estructura incorrecto es Trifásico",
}
STRUCTURE_SUBTYPE = {
    1: "Codigo Estructura incorrecto Unipolar Abierto",
    2: "Codigo estructura incorrecto Unipolar Cerrado",
    3: "Codigo estructura incorrecto Unipolar Abierto con Rompe arco",
}
STRUCTURE_CURRENT = {
    1: "Codigo Estructura incorrecto (Corriente), Secc Fusible Unipolar Abierto",
    2: "Codigo estructura incorrecto (Corriente), Secc Fusible Unipolar Cerrado",
    3: "Codigo estructura incorrecto (Corriente), Secc Fusible Unipolar Abierto con Rompe arco",
}
CAPACITY_MISSING = "Ingresar Capacidad en unidad fusible"
UNREADABLE_POWER = "Potencias no legibles = "
POWER_DIFFERS = "Potencia kva del Puesto es diferente al de la Unidad"
CONDUCTOR_MISSING = "Ingresar valor en Código Conductor Fase, configuración y secuencia de fase"
SEQUENCE_OUTSIDE = "Atributo SECUENCIAFASE tiene un valor que no corresponde con la FASE definida en el Tramo"
LAYOUT_PHASES = {
    1: "Configuracion de Conductor incorrecto es Monofásico",
    2: "Configuracion de Conductor incorrecto es Bifásico",
    3: "Configuracion de Conductor incorrecto es Trifásico",
}
LAYOUT_NO_NEUTRAL = "Configuracion de Conductor incorrecto no tiene Neutro"
LAYOUT_NEUTRAL = "Configuracion de Conductor incorrecto tiene Neutro"
CURRENT_MISSING = "Valor de Corriente inválido"
SHORT_CIRCUIT_MISSING = "Valor de Corriente Max Corto Circuito inválido"
PHASE_MISSING = "No tiene Fase especificada"
VOLTAGE_MISSING = "Valor de Voltaje inválido"
TAP_INVALID = "Valor invalido de Tap Normal, permitido: 1-5"
SIDE_MISSING = "Configuración lado baja ó media, vacío"
NULL_PHASE = "Fase NULL"
UNKNOWN_PHASE = "--"
PARALLEL_NOTE = "Ignorar si es Transformador en Paralelo"

# --- Fixed values: rows of the run itself ---------------------------------------------------
RUN_STARTED = "Inicio de Proceso"
RUN_FINISHED = "Fin de Proceso"
RUN_CLOCK = "%d/%m/%Y %H:%M:%S"
FAILURE_TEXT = "ERROR: "
UNREADABLE_VALUES = "ERROR: valores no legibles: "
UNREADABLE_TABLE, UNREADABLE_COLUMN = "Tabla: ", "Columna: "
FAILED_PROCEDURE = "Procedimiento: "
NO_FINDINGS = "NO EXISTE REGISTROS DE ERROR EN ArcGIS"
READ_FAILURE = "Error: "
