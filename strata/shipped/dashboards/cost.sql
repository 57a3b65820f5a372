with metered as (
  select year(usage_date) * 100 + month(usage_date) usage_month, from_json(usage_metadata, 'job_name string').job_name job, from_json(custom_tags, 'Owner string').Owner tagged, usage_quantity q from ops_usage
)
select usage_month, coalesce(job, 'untagged') pipeline, coalesce(tagged, 'unknown') owner, sum(q) units, sum(q) * cast({rate} as decimal(9,4)) cost
from metered group by all order by usage_month desc, units desc
