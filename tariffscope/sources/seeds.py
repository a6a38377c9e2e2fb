"""The two reference lists: payer patterns and shoppable services.

Both are plain CSV text that a reviewer can edit; ``read_patterns`` and ``read_services`` load an
edited copy from any path instead.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession

from tariffscope import schema

# Payer name pattern, carrier, priority (lower wins), insurance type override.
PAYER_PATTERNS_CSV = """\
pattern,payer_group,priority,product_line
%medicare replacement%,Other Medicare Advantage,5,Medicare Advantage
%mass general brigham health plan%,Mass General Brigham Health Plan,5,
%mass gen brigham%,Mass General Brigham Health Plan,5,
%mgb health plan%,Mass General Brigham Health Plan,5,
%allways%,Mass General Brigham Health Plan,5,
%wellsense%,WellSense Health Plan,5,
%bmc healthnet%,WellSense Health Plan,5,
%health safety net%,Health Safety Net (MA),5,Other government
hsn%,Health Safety Net (MA),5,Other government
%tricare%,TRICARE / VA,5,Other government
%champva%,TRICARE / VA,5,Other government
%veterans%,TRICARE / VA,5,Other government
%corrections%,Correctional health,5,Other government
%fmc devens%,Correctional health,5,Other government
%work comp%,Workers compensation,5,Workers comp
%workers comp%,Workers compensation,5,Workers comp
%pace,PACE / elder service plans,5,Other government
%elder service%,PACE / elder service plans,5,Other government
%corner esp,PACE / elder service plans,5,Other government
%covid%,HRSA COVID-19 uninsured fund,5,Other government
%usfhp%,TRICARE / VA,5,Other government
%us family health plan%,TRICARE / VA,5,Other government
%international%,International patients,5,Commercial
%mgbhp%,Mass General Brigham Health Plan,5,
%centers of excellence%,Mass General Brigham Health Plan,8,
%multiplan%,MultiPlan (rental network),10,
%phcs%,MultiPlan (rental network),10,
%claritev%,MultiPlan (rental network),10,
%molina%,Molina Healthcare,10,
%harvard pilgrim%,Point32Health (Harvard Pilgrim / Tufts),10,
%tufts%,Point32Health (Harvard Pilgrim / Tufts),10,
%point32%,Point32Health (Harvard Pilgrim / Tufts),10,
%hphc%,Point32Health (Harvard Pilgrim / Tufts),10,
%health plans inc%,Point32Health (Harvard Pilgrim / Tufts),10,
%medex%,Blue Cross Blue Shield,5,
%blue cross%,Blue Cross Blue Shield,10,
%bcbs%,Blue Cross Blue Shield,10,
%blue shield%,Blue Cross Blue Shield,10,
%aetna%,Aetna,10,
%meritain%,Aetna,10,
%cigna%,Cigna,10,
%united%,UnitedHealthcare,10,
%uhc%,UnitedHealthcare,10,
%umr%,UnitedHealthcare,10,
%oxford%,UnitedHealthcare,10,
%optum%,UnitedHealthcare,10,
%fallon%,Fallon Health,10,
%humana%,Humana,10,
%unicare%,Wellpoint (UniCare),10,
%wellpoint%,Wellpoint (UniCare),10,
%anthem%,Wellpoint (UniCare),10,
%wellcare%,WellCare,10,
%cca%,Commonwealth Care Alliance,10,
%commonwealth care alliance%,Commonwealth Care Alliance,10,
%senior whole health%,Senior Whole Health,10,
%eternal%,EternalHealth,10,
%health new england%,Health New England,10,
%hlth new england%,Health New England,10,
%masshealth%,MassHealth (Medicaid),15,
%medicaid%,MassHealth (Medicaid),20,
%medicare%,Medicare (traditional),30,Medicare (traditional)
"""

# The compared services by billing code.
SHOPPABLE_SERVICES_CSV = """\
billing_code,code_type,service_name,category
70551,CPT,MRI brain without contrast,Imaging
70553,CPT,MRI brain without then with contrast,Imaging
72148,CPT,MRI lumbar spine without contrast,Imaging
73721,CPT,MRI lower extremity joint without contrast,Imaging
70450,CPT,CT head without contrast,Imaging
74177,CPT,CT abdomen and pelvis with contrast,Imaging
71046,CPT,Chest X-ray (2 views),Imaging
76700,CPT,Ultrasound abdomen complete,Imaging
77067,CPT,Screening mammography (bilateral),Imaging
93005,CPT,Electrocardiogram (ECG) tracing - hospital component,Cardiology
45378,CPT,Colonoscopy (diagnostic),GI procedures
45380,CPT,Colonoscopy with biopsy,GI procedures
45385,CPT,Colonoscopy with polyp removal (snare),GI procedures
43239,CPT,Upper GI endoscopy with biopsy,GI procedures
29881,CPT,Knee arthroscopy with meniscectomy,Surgery
66984,CPT,Cataract removal with lens implant,Surgery
47562,CPT,Laparoscopic gallbladder removal,Surgery
49505,CPT,Inguinal hernia repair (age 5+),Surgery
80053,CPT,Comprehensive metabolic panel,Lab
80048,CPT,Basic metabolic panel,Lab
80061,CPT,Lipid panel,Lab
85025,CPT,Complete blood count (CBC) with differential,Lab
84443,CPT,Thyroid stimulating hormone (TSH),Lab
99203,CPT,New patient office visit (low complexity),Office visits
99213,CPT,Established patient office visit (low complexity),Office visits
99214,CPT,Established patient office visit (moderate complexity),Office visits
97110,CPT,Physical therapy - therapeutic exercise (15 min),Therapy
97161,CPT,Physical therapy evaluation (low complexity),Therapy
470,MS-DRG,Major hip or knee joint replacement without MCC,Inpatient
807,MS-DRG,Vaginal delivery without sterilization/D&C without CC/MCC,Inpatient
788,MS-DRG,Cesarean section without sterilization without CC/MCC,Inpatient
"""


def _rows(text: str) -> list[dict]:
    return [{k: v or None for k, v in row.items()} for row in csv.DictReader(io.StringIO(text))]


def pattern_rows() -> list[dict]:
    return [{**row, "priority": int(row["priority"])} for row in _rows(PAYER_PATTERNS_CSV)]


def service_rows() -> list[dict]:
    return _rows(SHOPPABLE_SERVICES_CSV)


def _literal(value) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_table(spark: SparkSession, rows: list[dict], columns: list[str]) -> DataFrame:
    """A small constant table inside the plan: no job, no Python rows."""
    values = ", ".join("(" + ", ".join(_literal(row[c]) for c in columns) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def payer_patterns(spark: SparkSession) -> DataFrame:
    return local_table(spark, pattern_rows(), schema.PAYER_PATTERNS.names)


def shoppable_services(spark: SparkSession) -> DataFrame:
    return local_table(spark, service_rows(), schema.SERVICES.names)


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.PAYER_PATTERNS).csv(path, header=True)


def read_services(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.SERVICES).csv(path, header=True)
