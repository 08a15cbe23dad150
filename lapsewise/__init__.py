"""lapsewise: lifecycle-campaign analytics as composable Spark DataFrame plans.

Entry points: ``plans.pipeline.CampaignRun`` / ``run_pipeline`` for a campaign
run, ``plans.queries`` for the registered queries, ``spec.CampaignSpec`` for
every campaign constant.
"""

__version__ = "0.1.0"
