"""Service-name rules as data.

Rows whose raw ``product_servicename`` is the generic data-transfer name get
the display name of their product code from ``DATA_TRANSFER_SERVICE_NAMES``.
The lookup is a join against a small table (``rules_frame``) instead of a
long CASE chain; unmapped codes keep the raw name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's rule list for identical results).
# Raw service name that triggers the lookup, and
# (line_item_product_code, display service name) pairs, in source order.
# Nine codes map to the empty string on purpose.
# ---------------------------------------------------------------------------
DATA_TRANSFER = "AWS Data Transfer"

DATA_TRANSFER_SERVICE_NAMES: list[tuple[str, str]] = [
    ("AmazonApiGateway", "Amazon API Gateway"),
    ("AmazonAthena", "Amazon Athena"),
    ("AmazonCloudFront", "Amazon CloudFront"),
    ("AmazonCloudWatch", "AmazonCloudWatch"),
    ("AmazonCognito", "Amazon Cognito"),
    ("AmazonDocDB", "Amazon DocumentDB (with MongoDB compatibility)"),
    ("AmazonDynamoDB", "Amazon DynamoDB"),
    ("AmazonEC2", "Amazon Elastic Compute Cloud"),
    ("AmazonECR", "Amazon EC2 Container Registry (ECR)"),
    ("AmazonECRPublic", "Amazon Elastic Container Registry Public"),
    ("AmazonECS", "Amazon Elastic Container Service"),
    ("AmazonEFS", "Amazon Elastic File System"),
    ("AmazonEKS", "Amazon Elastic Container Service for Kubernetes"),
    ("AmazonElastiCache", "Amazon ElastiCache"),
    ("AmazonES", "Amazon Elasticsearch Service"),
    ("AmazonForecast", "Amazon Forecast"),
    ("AmazonGlacier", ""),
    ("AmazonGuardDuty", "Amazon GuardDuty"),
    ("AmazonInspector", "Amazon Inspector"),
    ("AmazonKinesis", "Amazon Kinesis"),
    ("AmazonKinesisAnalytics", "Amazon Kinesis Analytics"),
    ("AmazonKinesisFirehose", "Amazon Kinesis Firehose"),
    ("AmazonLightsail", "Amazon Lightsail"),
    ("AmazonMCS", ""),
    ("AmazonMQ", ""),
    ("AmazonMSK", "Amazon Managed Streaming for Apache Kafka"),
    ("AmazonMWAA", "Amazon Managed Workflows for Apache Airflow"),
    ("AmazonNeptune", "Amazon Neptune"),
    ("AmazonPersonalize", "Amazon Personalize"),
    ("AmazonPolly", "Amazon Polly"),
    ("AmazonQuickSight", "Amazon QuickSight"),
    ("AmazonRDS", "Amazon Relational Database Service"),
    ("AmazonRedshift", "Amazon Redshift"),
    ("AmazonRekognition", "Amazon Rekognition"),
    ("AmazonRoute53", "Amazon Route 53"),
    ("AmazonS3", "Amazon Simple Storage Service"),
    ("AmazonS3GlacierDeepArchive", "Amazon S3 Glacier Deep Archive"),
    ("AmazonSageMaker", "Amazon SageMaker"),
    ("AmazonSES", "Amazon Simple Email Service"),
    ("AmazonSimpleDB", "Amazon SimpleDB"),
    ("AmazonSNS", "Amazon Simple Notification Service"),
    ("AmazonStates", ""),
    ("AmazonTimestream", "Amazon Timestream"),
    ("AmazonVPC", "Amazon Virtual Private Cloud"),
    ("AmazonWorkDocs", "Amazon WorkDocs"),
    ("AmazonWorkSpaces", "Amazon WorkSpaces"),
    ("AppFlow", "Amazon AppFlow"),
    ("AWSAmplify", "AWS Amplify"),
    ("AWSAppSync", "AWS AppSync"),
    ("AWSBackup", "AWS Backup"),
    ("AWSBudgets", "AWS Budgets"),
    ("AWSCertificateManager", "AWS Certificate Manager"),
    ("AWSCloudShell", "AWS CloudShell"),
    ("AWSCloudTrail", "AWS CloudTrail"),
    ("AWSCodeArtifact", "AWS CodeArtifact"),
    ("AWSCodeCommit", "AWS CodeCommit"),
    ("AWSCodePipeline", "AWS CodePipeline"),
    ("AWSConfig", "AWS Config"),
    ("AWSCostExplorer", "AWS Cost Explorer"),
    ("AWSDatabaseMigrationSvc", "AWS Database Migration Service"),
    ("AWSDataTransfer", "AWS Data Transfer"),
    ("AWSDirectoryService", "AWS Directory Service"),
    ("AWSELB", "Elastic Load Balancing"),
    ("AWSElementalMediaConvert", "AWS Elemental MediaConvert"),
    ("AWSElementalMediaLive", "AWS Elemental MediaLive"),
    ("AWSElementalMediaPackage", "AWS Elemental MediaPackage"),
    ("AWSElementalMediaStore", ""),
    ("AWSElementalMediaTailor", "AWS Elemental MediaTailor"),
    ("AWSEvents", ""),
    ("AWSGlobalAccelerator", "AWS Global Accelerator"),
    ("AWSGlue", "AWS Glue"),
    ("awskms", "AWS Key Management Service"),
    ("AWSLambda", "AWS Lambda"),
    ("AWSQueueService", "Amazon Simple Queue Service"),
    ("AWSSecretsManager", "AWS Secrets Manager"),
    ("AWSSecurityHub", "AWS Security Hub"),
    ("AWSShield", "AWS Shield"),
    ("AWSSystemsManager", "AWS Systems Manager"),
    ("AWSTransfer", "AWS Transfer Family"),
    ("awswaf", "AWS WAF"),
    ("AWSXRay", "AWS X-Ray"),
    ("CodeBuild", ""),
    ("comprehend", "Amazon Comprehend"),
    ("ComputeSavingsPlans", "Savings Plans for AWS Compute usage"),
    ("datapipeline", "AWS Data Pipeline"),
    ("ElasticMapReduce", "Amazon Elastic MapReduce"),
    ("OCBElasticComputeCloud", ""),
    ("OCBPremiumSupport", ""),
    ("translate", "Amazon Translate"),
]

# Names given to rows whose raw service name is empty, by product code.
EMPTY_NAME_SERVICE_NAMES: list[tuple[str, str]] = [
    ("AmazonEC2", "Amazon Elastic Compute Cloud"),
    ("AmazonRedshift", "Amazon Redshift"),
    ("AmazonElastiCache", "Amazon ElastiCache"),
    ("AmazonRDS", "Amazon Relational Database Service"),
]
# Empty raw name, this product code and item type 'Fee' -> the code itself.
EMPTY_NAME_FEE_CODE = "OCBElasticComputeCloud"
FEE = "Fee"
# Empty raw name and this billing entity -> prefix + product name.
MARKETPLACE = "AWS Marketplace"
MARKETPLACE_PREFIX = "AWS Marketplace "
# --------------------------- end of fixed values ---------------------------

RULES_SCHEMA = StructType(
    [
        StructField("rule_product_code", StringType(), False),
        StructField("rule_service_name", StringType(), False),
    ]
)

def rules_frame(spark: SparkSession, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """The data-transfer rule table as a DataFrame (one row per product code).

    Built as an inline table (a LocalRelation): no Python rows are shipped
    to executors, and broadcasting it needs no Spark job.
    """
    return _values_frame(spark, DATA_TRANSFER_SERVICE_NAMES if pairs is None else pairs)


def _values_frame(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    codes = [c for c, _ in rows]
    if len(codes) != len(set(codes)):
        raise ValueError("service rules must have unique product codes")
    values = ", ".join(f"({_sql_string(c)}, {_sql_string(n)})" for c, n in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS rules(rule_product_code, rule_service_name)")


def _sql_string(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
