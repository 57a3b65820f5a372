select count(distinct patient_key) patients_with_linkage, count(*) linkage_rows from gold_mart_clinical_survey_linkage
