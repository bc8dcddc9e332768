"""A small clinic. The rows the golden results below are stated for."""

import datetime as dt

from wardflow.sources import schemas
from wardflow.sources.tables import rows_frame

AS_OF = dt.date(2024, 10, 25)

PATIENT_COLUMNS = schemas.PATIENT.names[:-1]
PATIENTS = [
    ("P100001", "MRN-900001", "Maria", "Santos", "1965-03-14", "111-22-3333", "100 Hope St", "Providence", "RI", "02906", "401-555-0101", "msantos@example.com", "English", "Female"),
    ("P100002", "MRN-900002", "James", "Okafor", "1978-11-02", "222-33-4444", "45 Thayer St", "Providence", "RI", "02912", "401-555-0102", "jokafor@example.com", "English", "Male"),
    ("P100003", "MRN-900003", "Lin", "Chen", "1990-07-21", "333-44-5555", "200 Wickenden St", "Providence", "RI", "02903", "401-555-0103", "lchen@example.com", "Mandarin", "Female"),
    ("P100004", "MRN-900004", "Robert", "Williams", "1955-01-30", "444-55-6666", "88 Broad St", "Providence", "RI", "02903", "401-555-0104", "rwilliams@example.com", "English", "Male"),
    ("P100005", "MRN-900005", "Fatima", "Al-Hassan", "1988-09-15", "555-66-7777", "12 Benefit St", "Providence", "RI", "02904", "401-555-0105", "falhassan@example.com", "Arabic", "Female"),
    ("P100006", "MRN-900006", "David", "Park", "1972-04-08", "666-77-8888", "300 Brook St", "Providence", "RI", "02906", "401-555-0106", "dpark@example.com", "English", "Male"),
    ("P100007", "MRN-900007", "Sarah", "Johnson", "1983-12-25", "777-88-9999", "55 Power St", "Providence", "RI", "02906", "401-555-0107", "sjohnson@example.com", "English", "Female"),
    ("P100008", "MRN-900008", "Carlos", "Rivera", "1995-06-10", "888-99-0000", "400 Hope St", "Providence", "RI", "02906", "401-555-0108", "crivera@example.com", "Spanish", "Male"),
]
LATE_PATIENTS = [
    ("P100009", "MRN-900009", "Elena", "Vasquez", "2001-02-14", "999-00-1111", "500 Atwells Ave", "Providence", "RI", "02909", "401-555-0109", "evasquez@example.com", "Spanish", "Female"),
]

ENCOUNTER_COLUMNS = schemas.ENCOUNTER.names[:-1]
ENCOUNTERS = [
    ("E200001", "P100001", "Inpatient", "2024-08-10", "2024-08-14", "Cardiology", "PROV-001", "I21.0", "Acute ST-elevation MI", "Discharged", "45200.00"),
    ("E200002", "P100002", "Outpatient", "2024-09-01", None, "Primary Care", "PROV-002", "E11.9", "Type 2 diabetes mellitus", "Completed", "350.00"),
    ("E200003", "P100003", "Emergency", "2024-09-15", "2024-09-15", "Emergency Dept", "PROV-003", "S52.501A", "Fracture of lower end of radius", "Discharged", "8900.00"),
    ("E200004", "P100004", "Inpatient", "2024-09-20", "2024-09-28", "Oncology", "PROV-004", "C34.90", "Malignant neoplasm of lung", "Discharged", "72500.00"),
    ("E200005", "P100001", "Outpatient", "2024-10-01", None, "Cardiology", "PROV-001", "I21.0", "Acute ST-elevation MI follow-up", "Completed", "275.00"),
    ("E200006", "P100005", "Outpatient", "2024-10-05", None, "OB/GYN", "PROV-005", "Z34.00", "Supervision of normal pregnancy", "Completed", "425.00"),
    ("E200007", "P100006", "Inpatient", "2024-10-10", "2024-10-12", "Orthopedics", "PROV-006", "M17.11", "Primary osteoarthritis right knee", "Discharged", "38900.00"),
    ("E200008", "P100007", "Emergency", "2024-10-12", "2024-10-12", "Emergency Dept", "PROV-003", "J06.9", "Acute upper respiratory infection", "Discharged", "2100.00"),
    ("E200009", "P100008", "Outpatient", "2024-10-15", None, "Behavioral Health", "PROV-007", "F32.1", "Major depressive disorder moderate", "Completed", "310.00"),
    ("E200010", "P100002", "Inpatient", "2024-10-18", "2024-10-22", "Nephrology", "PROV-008", "N18.4", "Chronic kidney disease stage 4", "Discharged", "28700.00"),
]
LATE_ENCOUNTERS = [
    ("E200011", "P100009", "Emergency", "2024-10-25", "2024-10-25", "Emergency Dept", "PROV-003", "R10.9", "Unspecified abdominal pain", "Discharged", "3200.00"),
]

LAB_COLUMNS = schemas.LAB_RESULT.names[:-1]
LABS = [
    ("R001", "E200001", "P100001", "TROP", "Troponin I", "2.45", "ng/mL", "0.00", "0.04", "2024-08-10 06:30:00"),
    ("R002", "E200001", "P100001", "BNP", "BNP", "890.00", "pg/mL", "0.00", "100.00", "2024-08-10 06:30:00"),
    ("R003", "E200002", "P100002", "HBA1C", "HbA1c", "8.20", "%", "4.00", "5.60", "2024-09-01 09:00:00"),
    ("R004", "E200004", "P100004", "WBC", "WBC", "3.10", "K/uL", "4.50", "11.00", "2024-09-20 07:00:00"),
    ("R005", "E200010", "P100002", "CREAT", "Creatinine", "4.20", "mg/dL", "0.70", "1.30", "2024-10-18 08:00:00"),
    ("R006", "E200010", "P100002", "GFR", "eGFR", "22.00", "mL/min", "90.00", "120.00", "2024-10-18 08:00:00"),
    ("R007", "E200001", "P100001", "CHOL", "Total Cholesterol", "245.00", "mg/dL", "0.00", "200.00", "2024-08-10 06:30:00"),
    ("R008", "E200001", "P100001", "LDL", "LDL Cholesterol", "165.00", "mg/dL", "0.00", "100.00", "2024-08-10 06:30:00"),
    ("R009", "E200005", "P100001", "TROP", "Troponin I", "0.02", "ng/mL", "0.00", "0.04", "2024-10-01 10:00:00"),
    ("R010", "E200005", "P100001", "BNP", "BNP", "85.00", "pg/mL", "0.00", "100.00", "2024-10-01 10:00:00"),
]

PROVIDERS = [
    ("PROV-001", "Dr. Amy Chen", "Cardiology", "Cardiology", "1234567890", "true"),
    ("PROV-002", "Dr. Marcus Brown", "Internal Medicine", "Primary Care", "2345678901", "true"),
    ("PROV-003", "Dr. Lisa Park", "Emergency Medicine", "Emergency Dept", "3456789012", "true"),
    ("PROV-004", "Dr. James Wright", "Oncology", "Oncology", "4567890123", "true"),
    ("PROV-005", "Dr. Sarah Kim", "OB/GYN", "OB/GYN", "5678901234", "true"),
    ("PROV-006", "Dr. David Lee", "Orthopedic Surgery", "Orthopedics", "6789012345", "true"),
    ("PROV-007", "Dr. Nina Patel", "Psychiatry", "Behavioral Health", "7890123456", "true"),
    ("PROV-008", "Dr. Robert Garcia", "Nephrology", "Nephrology", "8901234567", "true"),
]

ACCESS = [("CLINICIAN", "Cardiology"), ("CLINICIAN", "Primary Care")]


def patients(spark, rows=PATIENTS):
    return rows_frame(spark, rows, schemas.PATIENT, PATIENT_COLUMNS)


def encounters(spark, rows=ENCOUNTERS):
    return rows_frame(spark, rows, schemas.ENCOUNTER, ENCOUNTER_COLUMNS)


def labs(spark, rows=LABS):
    return rows_frame(spark, rows, schemas.LAB_RESULT, LAB_COLUMNS)


def providers(spark, rows=PROVIDERS):
    return rows_frame(spark, rows, schemas.PROVIDER)


def access(spark):
    return rows_frame(spark, ACCESS, schemas.ROLE_ACCESS)


def frames(spark):
    return {
        "patients": patients(spark),
        "encounters": encounters(spark),
        "labs": labs(spark),
        "providers": providers(spark),
        "access": access(spark),
    }


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
