with base as (select p.age_band, r.readmission_30d from gold_fact_readmission r join gold_dim_patient p on r.patient_key = p.patient_key)
select age_band, count(*) index_stays, count_if(readmission_30d) readmissions_30d, round(count_if(readmission_30d) / count(*), 4) readmission_rate
from base group by age_band having count(*) >= 11 order by age_band
